"""Cheapest repair of a sequence of turns, by alignment to each target of the alternating grammar.

A turn is one byte: its role's initial (``u``, ``a``, ``s``, anything else ``x``), upper-case
if the text is truncated, or ``-`` for a turn that has to go.  A target is nothing, ``ua``
repeated, or that after one ``s``; one of every length but 1.  Repairs are spelt by initials:
D(elete) 4, I(nsert) 3, K(eep) 0, R(erole) 3, and a truncated turn that stays costs 3 more.
"""

from __future__ import annotations

from functools import lru_cache

DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
#: Sequences up to this many turns are aligned target by target; in longer ones all targets
#: that go on alike share their columns, so the work is in proportion to the turns.
LONG = 40
FAR = 1 << 60


def target(length: int) -> str:
    return "s" * (length % 2) + "ua" * (length // 2)


def _stay(turn: str, role: str) -> int | None:
    """What it costs that the turn takes the place of ``role``; None if it can't."""
    own = turn.lower()
    if turn == "-" or (role == "s" and own != "s"):
        return None
    return (TRUNCATED if turn.isupper() else 0) + (0 if own == role else REROLE)


def _free(turns: str) -> list[int]:
    """How many of the first i turns need not go."""
    out = [0]
    for t in turns:
        out.append(out[-1] + (t != "-"))
    return out


def align(turns: str, length: int, most: int) -> tuple[int, str] | None:
    """(cost, audit) of the repair to the target of ``length``, or None if it costs over ``most``.

    Wagner and Fischer's table of costs to go, within Ukkonen's band: a cell is left out if the
    turns to delete and the insertions or deletions that its place off the diagonal of free
    turns asks for, before and after it, exceed ``most``.
    """
    n, goal, free = len(turns), target(length), _free(turns)

    def drift(more: int) -> int:
        return INSERT * more if more > 0 else -DELETE * more

    gone = DELETE * (n - free[n])
    band = []
    for i in range(n + 1):
        inside = [
            j for j in range(length + 1)
            if gone + drift(j - free[i]) + drift((length - j) - (free[n] - free[i])) <= most
        ]
        if not inside:
            return None
        band.append((inside[0], inside[-1]))
    togo = [[FAR] * (length + 2) for _ in range(n + 2)]
    for i in range(n, -1, -1):
        for j in range(band[i][1], band[i][0] - 1, -1):
            best = 0 if (i, j) == (n, length) else FAR
            if i < n:
                best = min(best, DELETE + togo[i + 1][j])
            if j < length:
                if goal[j] != "s":
                    best = min(best, INSERT + togo[i][j + 1])
                stay = _stay(turns[i], goal[j]) if i < n else None
                if stay is not None:
                    best = min(best, stay + togo[i + 1][j + 1])
            togo[i][j] = best
    if togo[0][0] > most:
        return None
    audit, i, j = [], 0, 0
    while (i, j) != (n, length):
        left = togo[i][j]
        # In the order of their initials, so the first that fits gives the least audit.
        if i < n and DELETE + togo[i + 1][j] == left:
            audit.append("D")
            i += 1
        elif j < length and goal[j] != "s" and INSERT + togo[i][j + 1] == left:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if turns[i].lower() == goal[j] else "R")
            i, j = i + 1, j + 1
    return togo[0][0], "".join(audit)


def _by_target(turns: str) -> tuple[int, str]:
    n = len(turns)
    free = _free(turns)[n]
    gone = DELETE * (n - free)

    def least(length: int) -> int:
        return gone + (INSERT * (length - free) if length > free else DELETE * (free - length))

    # Deleting everything reaches the empty target: the first incumbent.
    best = (DELETE * n, "D" * n)
    lengths = [0, *range(2, 2 * n + 3)]
    for length in sorted(lengths, key=lambda x: (least(x), x)):
        if least(length) > best[0]:
            break
        found = align(turns, length, best[0])
        if found is not None:
            best = min(best, found)
    return best


# Where a target may stand: at its start, after a first s, before a u, before an a, at its end.
_START, _AFTER_S, _U, _A = range(4)
_STEPS = {
    _START: (("s", _AFTER_S), ("u", _A)),
    _AFTER_S: (("u", _A),),
    _U: (("u", _A),),
    _A: (("a", _U),),
}
_MAY_END = (_START, _U)


def _by_place(turns: str) -> tuple[int, str]:
    """The same repair when the columns of all targets that go on alike are one column."""
    n = len(turns)
    togo = [[FAR] * 4 for _ in range(n + 1)]

    def inserted(row: list[int]) -> None:
        # Two insertions lead from any place back to the next u, so three rounds settle.
        for _ in range(3):
            for place, steps in _STEPS.items():
                for role, then in steps:
                    if role != "s":
                        row[place] = min(row[place], INSERT + row[then])

    for place in _MAY_END:
        togo[n][place] = 0
    inserted(togo[n])
    for i in range(n - 1, -1, -1):
        row, after = togo[i], togo[i + 1]
        for place, steps in _STEPS.items():
            row[place] = DELETE + after[place]
            for role, then in steps:
                stay = _stay(turns[i], role)
                if stay is not None:
                    row[place] = min(row[place], stay + after[then])
        inserted(row)
    audit, i, place = [], 0, _START
    while not (i == n and togo[i][place] == 0):
        left = togo[i][place]
        if i < n and DELETE + togo[i + 1][place] == left:
            audit.append("D")
            i += 1
            continue
        step = next((then for role, then in _STEPS[place] if role != "s" and INSERT + togo[i][then] == left), None)
        if step is not None:
            audit.append("I")
            place = step
            continue
        fits = []
        for role, then in _STEPS[place]:
            stay = _stay(turns[i], role)
            if stay is not None and stay + togo[i + 1][then] == left:
                fits.append(("K" if turns[i].lower() == role else "R", then))
        edit, place = min(fits)
        audit.append(edit)
        i += 1
    return togo[0][_START], "".join(audit)


@lru_cache(maxsize=10_000)
def _short(turns: str) -> tuple[int, str]:
    return _by_target(turns)


def repair(turns: str) -> tuple[int, str]:
    """(cost, audit): the least cost, and of the repairs of that cost the ASCII-least audit."""
    return _short(turns) if len(turns) <= LONG else _by_place(turns)


def repaired_roles(audit: str) -> list[str | None]:
    """For each edit of ``audit`` the initial that its turn has in the target; None if deleted."""
    roles = iter(target(sum(e != "D" for e in audit)))
    return [None if e == "D" else next(roles) for e in audit]
