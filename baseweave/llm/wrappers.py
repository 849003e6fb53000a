"""Wrappers of hosts: which texts come at the same place of many of a host's pages.

A page's skeleton is its tree with equal siblings as one slot. Simple tree
matching (the largest top-down matching that keeps the order of children)
aligns skeletons; as siblings differ, matching children is choosing the
heaviest increasing sequence of common labels.
"""

from __future__ import annotations

from bisect import bisect_left

from .dom import HEADINGS, Page

#: Share of a region's characters that stay at least; a page that is template beyond that is taken for a copy of others.
LEAST_OWN = 0.5
#: Share of a container's characters that a part of it has to have to be the container itself.
CONTAINER = 0.7


class Skeleton:
    """Slots by number, parents first, from or to one line of text."""

    def __init__(self, labels: list[str], parents: list[int]) -> None:
        self.labels, self.parents = labels, parents
        self.children: list[dict[str, int]] = [{} for _ in labels]
        for k, (label, parent) in enumerate(zip(labels, parents, strict=True)):
            if parent >= 0:
                self.children[parent][label] = k

    @classmethod
    def of(cls, page: Page) -> tuple[Skeleton, list[int]]:
        """The skeleton and the slot of each node."""
        labels, parents, slots, known = [page.labels[0]], [-1], [0], {}
        for k in range(1, len(page.labels)):
            key = (slots[page.parents[k]], page.labels[k])
            if key not in known:
                known[key] = len(labels)
                labels.append(page.labels[k])
                parents.append(key[0])
            slots.append(known[key])
        return cls(labels, parents), slots

    def line(self) -> str:
        return "\n".join(f"{p}\t{x}" for p, x in zip(self.parents, self.labels, strict=True))

    @classmethod
    def read(cls, line: str) -> Skeleton:
        pairs = [x.split("\t", 1) for x in line.split("\n")]
        return cls([x for _, x in pairs], [int(p) for p, _ in pairs])


def _heaviest(pairs: list[tuple[int, int, int]]) -> list[int]:
    """Which of (place, other place, weight), by ascending place, make the heaviest sequence of ascending other places."""
    others = sorted(p[1] for p in pairs)
    best: list[tuple[int, int]] = [(0, -1)] * (len(pairs) + 1)  # a tree of prefix maxima by other place
    before = []
    for k, (_, other, weight) in enumerate(pairs):
        i, top = bisect_left(others, other), (0, -1)
        j = i
        while j > 0:
            top = max(top, best[j])
            j -= j & -j
        before.append(top[1])
        j, now = i + 1, (top[0] + weight, k)
        while j <= len(pairs):
            best[j] = max(best[j], now)
            j += j & -j
    k = max(best)[1]
    chosen = []
    while k >= 0:
        chosen.append(k)
        k = before[k]
    return chosen[::-1]


def align(page: Skeleton, reference: Skeleton) -> list[int]:
    """For each slot of ``page`` the slot of ``reference`` that simple tree matching gives it, or -1."""
    found = [-1] * len(page.labels)
    # Pairs of slots with the same labels from the root on, children after parents; weights go up from the last.
    pairs, at = [(0, 0)], 0
    if page.labels[0] != reference.labels[0]:
        return found
    while at < len(pairs):
        a, b = pairs[at]
        mine, theirs = page.children[a], reference.children[b]
        pairs += [(k, theirs[x]) for x, k in mine.items() if x in theirs]
        at += 1
    weight, chosen = {}, {}
    for a, b in reversed(pairs):
        mine, theirs = list(page.children[a].items()), reference.children[b]
        rank = {x: k for k, x in enumerate(theirs)}
        common = [(k, rank[x], weight[(c, theirs[x])]) for k, (x, c) in enumerate(mine) if x in theirs]
        kept = _heaviest(common)
        chosen[(a, b)] = [(mine[common[k][0]][1], theirs[mine[common[k][0]][0]]) for k in kept]
        weight[(a, b)] = 1 + sum(common[k][2] for k in kept)
    live = [(0, 0)]
    while live:
        a, b = live.pop()
        found[a] = b
        live += chosen[(a, b)]
    return found


def _beside(page: Page) -> list[bool]:
    """Whether each node stands beside the main text, by itself or by an element around it."""
    stays, headings, out = 0, 1, 2
    holds, in_main, state = ([False] * len(page.tags) for _ in range(3))
    for k in range(len(page.tags) - 1, 0, -1):
        if holds[k] or page.mains[k]:
            holds[page.parents[k]] = True
    for k in range(1, len(page.tags)):
        up, kind, tag = page.parents[k], page.kinds[k], page.tags[k]
        in_main[k] = in_main[up] or bool(page.mains[k])
        state[k] = stays if state[up] == headings and tag in HEADINGS else state[up]
        if kind == "aside" and not (tag == "form" and holds[k]) or kind == "named" and not holds[k] and not page.mains[k]:
            state[k] = out
        elif kind == "header" and not holds[k]:  # of a header inside the main text its headings stay
            state[k] = max(state[k], headings if in_main[up] else out)
    return [s != stays for s in state]


def region(page: Page) -> list[int]:
    """Numbers of the blocks of the main text, by the page's own elements: the article, else the main part, else the container of most text."""
    beside = _beside(page)
    left = [k for k, b in enumerate(page.blocks) if not beside[b.node]]
    size = [0] * len(page.tags)
    for k in left:
        size[page.blocks[k].node] += len(page.blocks[k].text)
    for k in range(len(page.tags) - 1, 0, -1):
        size[page.parents[k]] += size[k]
    within = [-1] * len(page.tags)
    for wanted in ("article", "main"):
        for k in range(1, len(page.tags)):
            up = within[page.parents[k]]
            within[k] = up if up >= 0 else k if page.mains[k] == wanted and size[k] else -1
        tops = sorted({w for w in within if w >= 0}, key=lambda k: -size[k])
        if tops:
            whole = sum(size[k] for k in tops)
            wide = set(tops[:1] if 2 * size[tops[0]] >= whole else tops)
            return [k for k in left if within[page.blocks[k].node] in wide]
        within = [-1] * len(page.tags)
    return _densest(page, [k for k in left if 2 * page.blocks[k].linked <= len(page.blocks[k].text)])


def _densest(page: Page, left: list[int]) -> list[int]:
    """Of ``left`` the blocks of the smallest element that holds most of their text."""
    size = [0] * len(page.tags)
    for k in left:
        size[page.blocks[k].node] += len(page.blocks[k].text) - page.blocks[k].linked
    for k in range(len(page.tags) - 1, 0, -1):
        size[page.parents[k]] += size[k]
    children: list[list[int]] = [[] for _ in page.tags]
    for k in range(1, len(page.tags)):
        children[page.parents[k]].append(k)
    top = 0
    while children[top]:
        largest = max(children[top], key=lambda k: size[k])
        if size[largest] < CONTAINER * size[top] or not children[largest] or size[largest] == 0:
            break
        top = largest
    inside = [False] * len(page.tags)
    inside[top] = True
    for k in range(top + 1, len(page.tags)):
        inside[k] = inside[page.parents[k]]
    return [k for k in left if inside[page.blocks[k].node]]


def main_text(page: Page, template: list[bool]) -> str:
    """Blocks of the main text, one a line; ``template`` tells of each block whether the host's wrapper has it."""
    kept = region(page)
    own = [k for k in kept if not template[k]]
    size = lambda which: sum(len(page.blocks[k].text) for k in which)
    if size(own) < LEAST_OWN * size(kept):
        own = kept
    return "\n".join(page.blocks[k].text for k in own)

