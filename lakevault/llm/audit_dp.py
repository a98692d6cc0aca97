"""Cheapest edits of a conversation, by dynamic programming over persistent audit strings.

A repaired conversation's role initials read ``(s?(ua)+)?``. The states are what has been read so
far: nothing, a leading s, a user's or an assistant's turn. Each row is kept, given the role the
state asks for, or deleted; an empty turn may be put in at any place. Every state holds its cheapest
edits, and among equally cheap ones those whose initials (D, I, K, R) are least.

These initials are never copied. A node of ``Audits`` is one letter behind a parent node, so states
share their prefixes; a node keeps its ancestors at distances 1, 2, 4, ... and a rolling hash of its
string. Two strings are compared by searching their longest common prefix: both nodes climb by
powers of two while their hashes differ. Equal hashes are verified by walking down the two lines
until they meet in one node, and a collision is settled letter by letter.

Two equally cheap strings for the same rows and state are never prefixes of one another, since the
longer one would have paid for an inserted turn; so the least string of a state always extends the
least strings of the states before it. For the same reason runs of rows can be solved apart, from
every state to every state, and joined in order.
"""

from __future__ import annotations

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
#: The state after a turn with this initial, by the state before.
AFTER = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: The turn that each state asks for: what an inserted or rerolled one is.
NEXT = ("user", "user", "assistant", "user")
ENDS = (START, ASSISTANT)
_PRIME = (1 << 61) - 1
_BASE = 911_382_323


class Audits:
    """Strings that share their prefixes. Node 0 is the empty string."""

    def __init__(self, prime: int = _PRIME):
        self.prime = prime
        self.letter, self.depth, self.hash = [""], [0], [0]
        self.up: list[tuple[int, ...]] = [()]

    def push(self, node: int, letter: str) -> int:
        """The string with one more letter."""
        new = len(self.letter)
        up, at, k = [node], node, 0
        while k < len(self.up[at]):  # the ancestor at 2**(k+1) is that at 2**k of the one at 2**k
            at = self.up[at][k]
            up.append(at)
            k += 1
        self.letter.append(letter)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * _BASE + ord(letter)) % self.prime)
        self.up.append(tuple(up))
        return new

    def extend(self, node: int, letters: str) -> int:
        for letter in letters:
            node = self.push(node, letter)
        return node

    def ancestor(self, node: int, depth: int) -> int:
        """The prefix of this length."""
        climb = self.depth[node] - depth
        while climb:
            k = climb.bit_length() - 1
            node = self.up[node][k]
            climb -= 1 << k
        return node

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def same(self, a: int, b: int) -> bool:
        """Whether two strings of equal length and hash are equal: walked until the lines meet."""
        while a != b:
            if self.letter[a] != self.letter[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether the first string comes before the second."""
        if a == b:
            return False
        depth = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        if self.hash[x] == self.hash[y]:
            if self.same(x, y):
                return self.depth[a] < self.depth[b]
            return self.text(a) < self.text(b)
        k = len(self.up[x]) - 1
        while k >= 0:  # to the first letter at which they differ
            if k < len(self.up[x]) and self.hash[self.up[x][k]] != self.hash[self.up[y][k]]:
                x, y = self.up[x][k], self.up[y][k]
            k -= 1
        if self.same(self.up[x][0], self.up[y][0]):
            return self.letter[x] < self.letter[y]
        return self.text(a) < self.text(b)

    def better(self, one: tuple[int, int] | None, two: tuple[int, int] | None):
        """The cheaper of two (cost, string), the lesser string if both cost the same."""
        if one is None or two is None:
            return two if one is None else one
        if one[0] != two[0]:
            return one if one[0] < two[0] else two
        return two if self.less(two[1], one[1]) else one


Best = list["tuple[int, int] | None"]


def with_inserts(audits: Audits, best: Best) -> Best:
    """The best of every state when turns may be put in now."""
    wave, best = best, list(best)
    for _ in range(STATES - 1):
        reached: Best = [None] * STATES
        for state, found in enumerate(wave):
            if found is None:
                continue
            to = AFTER[state][NEXT[state][0]]
            cost = found[0] + INSERT_COST
            if best[to] is None or cost <= best[to][0]:
                made = (cost, audits.push(found[1], INSERT))
                if audits.better(best[to], made) is made:
                    best[to] = reached[to] = made
        wave = reached
        if not any(wave):
            break
    return best


def step(audits: Audits, best: Best, initial: str, must_go: bool, truncated: bool) -> Best:
    """The best of every state after one more row."""
    best = with_inserts(audits, best)
    out: Best = [None] * STATES

    def offer(to: int, cost: int, node: int, letter: str) -> None:
        if out[to] is None or cost <= out[to][0]:
            out[to] = audits.better(out[to], (cost, audits.push(node, letter)))

    for state, found in enumerate(best):
        if found is None:
            continue
        cost, node = found
        offer(state, cost + DELETE_COST, node, DELETE)
        if must_go:
            continue
        if initial in AFTER[state]:
            offer(AFTER[state][initial], cost + truncated, node, KEEP)
        offer(AFTER[state][NEXT[state][0]], cost + REROLE_COST + truncated, node, REROLE)
    return out


def finish(audits: Audits, best: Best) -> tuple[int, int, int]:
    """(state, cost, string) of the best whole conversation."""
    best = with_inserts(audits, best)
    state = START if best[ASSISTANT] is None or (
        best[START] is not None and audits.better(best[START], best[ASSISTANT]) is best[START]
    ) else ASSISTANT
    return (state, *best[state])


def begin(state: int = START) -> Best:
    best: Best = [None] * STATES
    best[state] = (0, 0)
    return best


def solve(rows: list[tuple[str, bool, bool]]) -> tuple[int, str]:
    """(cost, audit) of rows given as (initial, must go, truncated)."""
    audits, best = Audits(), begin()
    for row in rows:
        best = step(audits, best, *row)
    _, cost, node = finish(audits, best)
    return cost, audits.text(node)


def transfer(rows: list[tuple[str, bool, bool]]) -> list[tuple[int, int, int, str]]:
    """(from, to, cost, audit) of a run of rows, for each state to begin and each to end with."""
    out = []
    for begun in range(STATES):
        audits, best = Audits(), begin(begun)
        for row in rows:
            best = step(audits, best, *row)
        out += [(begun, to, found[0], audits.text(found[1]))
                for to, found in enumerate(best) if found is not None]
    return out


def join(runs: list[list[tuple[int, int, int, str]]]) -> tuple[int, list[tuple[int, str]]]:
    """Cost, and (state to begin with, audit) of each run in order and of what follows the last."""
    audits, best = Audits(), begin()
    back: list[list[tuple[int, str] | None]] = []
    for run in runs:
        out: Best = [None] * STATES
        came: list[tuple[int, str] | None] = [None] * STATES
        for begun, to, cost, letters in run:
            if best[begun] is None:
                continue
            total = best[begun][0] + cost
            if out[to] is None or total <= out[to][0]:
                made = (total, audits.extend(best[begun][1], letters))
                if audits.better(out[to], made) is made:
                    out[to], came[to] = made, (begun, letters)
        best = out
        back.append(came)
    finals: Best = [None] * STATES
    tails: dict[int, list[tuple[int, int]]] = {e: [] for e in ENDS}
    for state, found in enumerate(best):
        if found is not None:
            alone: Best = [None] * STATES
            alone[state] = found
            closed = with_inserts(audits, alone)
            for e in ENDS:
                if closed[e] is not None:
                    tails[e].append((state, closed[e][1]))
                    finals[e] = audits.better(finals[e], closed[e])
    end = START if finals[ASSISTANT] is None or (
        finals[START] is not None and audits.better(finals[START], finals[ASSISTANT]) is finals[START]
    ) else ASSISTANT
    cost, node = finals[end]
    state = next(s for s, n in tails[end] if n == node)
    tail = audits.text(node)[audits.depth[best[state][1]]:]
    pieces = [(state, tail)]
    for came in reversed(back):
        begun, letters = came[state]
        pieces.append((begun, letters))
        state = begun
    return cost, pieces[::-1]


def render(rows: list[tuple[str, str]], audit: str, state: int = START) -> list[tuple[str, str]]:
    """The repaired (role, text) that an audit makes of rows, begun in a state."""
    out, given = [], iter(rows)
    for letter in audit:
        if letter == INSERT:
            role, text = NEXT[state], ""
        else:
            role, text = next(given)
            if letter == DELETE:
                continue
            role = NEXT[state] if letter == REROLE else role
        state = AFTER[state][role[:1]]
        out.append((role, text))
    return out
