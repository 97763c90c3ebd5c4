"""What a frame range of a video does to the order of its tracks.

The greedy tracker lets tracks choose in order of their age. That is a serial
dictatorship, so its outcome is the one stable matching of tracks (preferring
by IoU) with boxes (all preferring the older track), and deferred acceptance
finds it by asking "is x older than y?" only where both propose to one box.

Inside a range the age of a track is its birth key ``(frame, det_id)``; only the
tracks alive in the frame before it (the *seeds*) have an unknown order, and
they are older than all others. A range is therefore a function from the order
of its seeds to the labels of its last frame's boxes, kept as *pieces*:

``{"n": seeds, "last": [label], "mazes": [maze]}``
    A label is a seed number or a birth key ``[frame, det_id]``; None belongs to
    a maze. A maze is a decision graph ``{"ask": [[x, y, yes, no]], "root": ref,
    "ends": [[[place, label]]]}``: at a node go to ``yes`` if seed x is older than
    seed y; a ref below zero is the end ``-ref - 1``. Boxes that never share a
    chain of overlaps in the range are in different mazes.
``{"n": seeds, "prefs": [[place]], "born": [[frame, det_id]]}``
    One frame step as it stands (seeds' choices in order), used where a graph
    would have more than ``LIMIT`` ends: evaluated by the same rule, never capped.

``compose`` joins neighbouring ranges; a piece with no seeds forgets all before
it, so ranges are cut at frames without vehicles.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: States of one component, and nodes and ends of one maze, beyond which a range is kept in several pieces.
LIMIT = 256

Label = int | list
Piece = dict


class TooLarge(Exception):
    """A decision graph outgrows LIMIT at this layer."""

    def __init__(self, layer: int = 0) -> None:
        super().__init__(layer)
        self.layer = layer


class Unknown(Exception):
    """The order of these two seeds is needed."""


# -- one step -------------------------------------------------------------------


def preferences(iou: np.ndarray, threshold: float) -> list[list[int]]:
    """For every track the boxes it may take, best first (ties: the first box)."""
    out = []
    for row in iou:
        able = np.flatnonzero((row > 0) & (row >= threshold))
        out.append([int(j) for j in able[np.argsort(-row[able], kind="stable")]])
    return out


def stable_matching(prefs: list[list[int]], older: Callable[[int, int], bool]) -> dict[int, int]:
    """box -> track by deferred acceptance; ``older`` is asked about tracks that want one box."""
    at, holder = [0] * len(prefs), {}
    for first in range(len(prefs)):
        track = first
        while at[track] < len(prefs[track]):
            box = prefs[track][at[track]]
            at[track] += 1
            if box not in holder:
                holder[box] = track
                break
            if older(track, holder[box]):
                track, holder[box] = holder[box], track
    return holder


# -- known parts of an order ------------------------------------------------------


def with_fact(facts: frozenset, x: int, y: int) -> frozenset:
    """``facts`` (pairs: older, younger; transitively closed) and x older than y."""
    above = {x} | {a for a, b in facts if b == x}
    below = {y} | {b for a, b in facts if a == y}
    return facts | {(a, b) for a in above for b in below}


def is_older(a: Label, b: Label, facts: frozenset) -> bool | None:
    """Whether track ``a`` is older than ``b``; None if the facts do not say."""
    if isinstance(a, int) and isinstance(b, int):
        return True if (a, b) in facts else False if (b, a) in facts else None
    if isinstance(a, int) or isinstance(b, int):
        return isinstance(a, int)
    return tuple(a) < tuple(b)


# -- decision graphs ----------------------------------------------------------------


class Graph:
    """Nodes and ends of a maze, each kept once."""

    def __init__(self) -> None:
        self.ask: list[list[int]] = []
        self.ends: list = []
        self._nodes: dict[tuple, int] = {}
        self._ends: dict[str, int] = {}

    def end(self, places: list) -> int:
        key = repr(places)
        if key not in self._ends:
            self._ends[key] = len(self.ends)
            self.ends.append(places)
        return -self._ends[key] - 1

    def node(self, x: int, y: int, yes: int, no: int) -> int:
        if yes == no:
            return yes
        if (x, y, yes, no) not in self._nodes:
            if len(self.ask) >= LIMIT:
                raise TooLarge
            self._nodes[x, y, yes, no] = len(self.ask)
            self.ask.append([x, y, yes, no])
        return self._nodes[x, y, yes, no]

    def maze(self, root: int) -> dict:
        return {"ask": self.ask, "root": root, "ends": self.ends}


def branches(labels: tuple, prefs: list[list[int]], births: list, facts: frozenset, room: list[int]):
    """The tree of outcomes of one step: ("end", labels, facts) or (x, y, yes, no)."""

    def older(i: int, k: int) -> bool:
        known = is_older(labels[i], labels[k], facts)
        if known is None:
            raise Unknown(labels[i], labels[k])
        return known

    try:
        holder = stable_matching(prefs, older)
    except Unknown as e:
        x, y = e.args
        yes = branches(labels, prefs, births, with_fact(facts, x, y), room)
        return (x, y, yes, branches(labels, prefs, births, with_fact(facts, y, x), room))
    room[0] -= 1
    if room[0] < 0:
        raise TooLarge
    out = tuple(labels[holder[j]] if j in holder else born for j, born in enumerate(births))
    alive = {x for x in out if isinstance(x, int)}
    return ("end", out, frozenset((a, b) for a, b in facts if a in alive and b in alive))


def component_maze(seeds: list[int], steps: list[tuple[list[list[int]], list]], places: list[int] | None) -> tuple[bool, dict | None]:
    """(whether the seeds' order matters, maze) of a component.

    ``steps``: per frame the choices of the boxes before and the birth keys of
    its boxes. ``places``: positions of its last boxes in the last frame of the
    range; None where it ends earlier, and nothing is left to tell.
    """
    slots: list = [None]  # a slot is filled with a tree whose ends are later slots
    frontier = {(tuple(seeds), frozenset()): 0}
    matters = False

    def to_slots(tree, later: dict):
        if tree[0] == "end":
            key = (tree[1], tree[2])
            if key not in later:
                later[key] = len(slots)
                slots.append(None)
            return later[key]
        return (tree[0], tree[1], to_slots(tree[2], later), to_slots(tree[3], later))

    for layer, (prefs, births) in enumerate(steps):
        later: dict = {}
        for (labels, facts), slot in frontier.items():
            try:
                tree = branches(labels, prefs, [tuple(b) for b in births], facts, [LIMIT])
            except TooLarge:
                raise TooLarge(layer) from None
            matters |= tree[0] != "end"
            slots[slot] = to_slots(tree, later)
        if len(later) > LIMIT:
            raise TooLarge(layer)
        frontier = later
        if matters and places is None:
            return True, None
    if not matters or places is None:
        return matters, None

    graph = Graph()
    final = {slot: graph.end([[p, list(x) if isinstance(x, tuple) else x] for p, x in zip(places, labels)]) for (labels, _), slot in frontier.items()}
    ref: dict[int, int] = {}

    def settled(tree) -> int:
        return ref[tree] if isinstance(tree, int) else graph.node(tree[0], tree[1], settled(tree[2]), settled(tree[3]))

    try:
        for slot in reversed(range(len(slots))):  # later slots were made later
            ref[slot] = final[slot] if slot in final else settled(slots[slot])
    except TooLarge:
        raise TooLarge(len(steps) - 1) from None
    return True, graph.maze(ref[0])


# -- evaluation and composition -------------------------------------------------------


def evaluate(piece: Piece, keys: list[tuple]) -> list[tuple]:
    """Birth keys of the last frame's boxes, given those of the seeds."""
    if "prefs" in piece:
        holder = stable_matching(piece["prefs"], lambda i, k: keys[i] < keys[k])
        return [keys[holder[j]] if j in holder else tuple(born) for j, born in enumerate(piece["born"])]

    def key(label: Label) -> tuple:
        return keys[label] if isinstance(label, int) else tuple(label)

    out = [None if x is None else key(x) for x in piece["last"]]
    for maze in piece["mazes"]:
        ref = maze["root"]
        while ref >= 0:
            x, y, yes, no = maze["ask"][ref]
            ref = yes if keys[x] < keys[y] else no
        for place, label in maze["ends"][-ref - 1]:
            out[place] = key(label)
    return out


def joined(a: Piece, b: Piece) -> Piece | None:
    """``a`` and then ``b`` as one piece; None if a graph would outgrow LIMIT, or one is a bare step."""
    if b["n"] == 0:
        return b
    if "prefs" in a or "prefs" in b:
        return None
    owner = {place: m for m, maze in enumerate(a["mazes"]) for place, _ in maze["ends"][0]}

    def seeds_of(maze: dict) -> set[int]:
        asked = {s for x, y, _, _ in maze["ask"] for s in (x, y)}
        return asked | {label for end in maze["ends"] for _, label in end if isinstance(label, int)}

    # mazes that hang together: of b through the seeds they ask about, single boxes through the seed they show
    last: list = []
    parts: list[tuple[set[int], list[int], list[tuple[int, Label]]]] = []  # mazes of a, mazes of b, (place, label) of b
    for place, label in enumerate(b["last"]):
        if not isinstance(label, int):
            last.append(label)
        elif label in owner:
            last.append(None)
            parts.append(({owner[label]}, [], [(place, label)]))
        else:
            last.append(a["last"][label])
    parts += [({owner[s] for s in seeds_of(maze) if s in owner}, [m], []) for m, maze in enumerate(b["mazes"])]
    groups: list = []
    for part in parts:
        near = [g for g in groups if g[0] & part[0]]
        groups = [g for g in groups if not g[0] & part[0]]
        for g in near:
            part = (part[0] | g[0], part[1] + g[1], part[2] + g[2])
        groups.append(part)

    mazes = []
    try:
        for of_a, of_b, shown in groups:
            mazes.append(_joined_maze(a, [a["mazes"][m] for m in sorted(of_a)], [b["mazes"][m] for m in of_b], shown))
    except TooLarge:
        return None
    return {"n": a["n"], "last": last, "mazes": mazes}


def _joined_maze(a: Piece, first: list[dict], second: list[dict], shown: list[tuple[int, Label]]) -> dict:
    graph = Graph()
    stages = [*first, *second]
    memo: dict[tuple, int] = {}

    def walk(stage: int, ref: int, labels: tuple, told: tuple, facts: frozenset) -> int:
        """``labels``: (place in a's last frame, label) chosen so far; ``told``: ends of b's mazes."""
        at = (stage, ref, labels, told, facts)
        if at in memo:
            return memo[at]
        if len(memo) > 16 * LIMIT:
            raise TooLarge
        held = dict(labels)

        def label_of(seed: int) -> Label:
            label = held[seed] if seed in held else a["last"][seed]
            return label if isinstance(label, int) else tuple(label)

        if stage == len(stages):
            end = [[place, label_of(s)] for place, s in shown]
            for m, ref_b in zip(second, told):
                end += [[place, label_of(x) if isinstance(x, int) else x] for place, x in m["ends"][-ref_b - 1]]
            out = graph.end(sorted([place, list(x) if isinstance(x, tuple) else x] for place, x in end))
        elif ref < 0:
            if stage < len(first):
                labels += tuple((place, x if isinstance(x, int) else tuple(x)) for place, x in first[stage]["ends"][-ref - 1])
            else:
                told += (ref,)
            following = stages[stage + 1]["root"] if stage + 1 < len(stages) else -1
            out = walk(stage + 1, following, labels, told, facts)
        else:
            x, y, yes, no = stages[stage]["ask"][ref]
            if stage >= len(first):
                x, y = label_of(x), label_of(y)
            known = is_older(x, y, facts)
            if known is None:
                out = graph.node(x, y, walk(stage, yes, labels, told, with_fact(facts, x, y)), walk(stage, no, labels, told, with_fact(facts, y, x)))
            else:
                out = walk(stage, yes if known else no, labels, told, facts)
        memo[at] = out
        return out

    return graph.maze(walk(0, stages[0]["root"] if stages else -1, (), (), frozenset()))


def compose(pieces: list[Piece]) -> list[Piece]:
    """The pieces of neighbouring ranges, as few as the limit allows."""
    out: list[Piece] = []
    for piece in pieces:
        if piece["n"] == 0:
            out = []  # nothing before it is seen any more
        both = joined(out[-1], piece) if out else None
        if both is None:
            out.append(piece)
        else:
            out[-1] = both
    return out
