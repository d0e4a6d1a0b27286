"""A BPE tokenizer as a deterministic transducer that emits token counts.

BPE has a local criterion: a sequence of tokens is the encoding of its text exactly if every two
neighbours are the encoding of their own text, since merges inside two neighbours run the same
whatever stands beside them as long as no merge crosses their border. So each prefix of a text has one
last token, found from the prefixes before it. What decides all that follows is the set of open
starts: for each place where a token may still be under way, the token before it, the node of
the vocabulary's tree reached since, and how many tokens lie before it, counted from now. These
sets are the states. A transition reads a character and emits by how much the count of tokens changes.
States and transitions are compiled when they are first met, as in lazy determinisation, and kept
up to a bound.

The border before a space mark never has a merge across it, so the state after it is always the same.
It splits the machine's work into segments, which is also how maps of chunks compose, see ``ChunkMap``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache
from heapq import heapify, heappop, heappush

import sentencepiece

MARK = "▁"  # stands for a space
STATES = 300_000  # compiled at most, then compiled anew
SEGMENTS = 500_000  # counts kept at most

_SEGMENT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


@dataclass
class _Node:
    """A node of the tree of pieces."""

    text: str
    is_piece: bool = False
    next: dict[str, _Node] = field(default_factory=dict)


class Transducer:
    """Counts the tokens of a sentencepiece BPE model with byte fallback."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.score = {model.id_to_piece(i): model.get_score(i) for i in ids}
        probe = " a  b\n "
        if model.normalize(probe) != MARK + probe.replace(" ", MARK):
            raise ValueError(f"{path}: only models that keep all white space are compiled")
        if any(MARK in p.lstrip(MARK) for p in self.score):
            raise ValueError(f"{path}: a piece goes on beyond a space")
        self.touching = {p[n : n + 2] for p in self.score for n in range(len(p) - 1)}
        self.root = _Node("")
        for piece in self.score:
            node = self.root
            for n, c in enumerate(piece, 1):
                node = node.next.setdefault(c, _Node(piece[:n]))
            node.is_piece = self._encoded(piece) == [piece]  # else no text has it as a token
        self.counts: dict[str, int] = {}
        self._reset()

    def _reset(self) -> None:
        """Forget the compiled states; state 0 is that at a border."""
        self.fits: dict[tuple[str, str], bool] = {}
        self.number: dict[tuple, int] = {}
        self.starts: list[tuple] = []
        self.moves: list[dict[str, tuple[int, int]]] = []
        self._state(((None, self.root, 0),))

    def _state(self, starts: tuple) -> int:
        name = tuple((token, id(node), before) for token, node, before in starts)
        if name not in self.number:
            self.number[name] = len(self.starts)
            self.starts.append(starts)
            self.moves.append({})
        return self.number[name]

    def _encoded(self, text: str) -> list[str]:
        """The tokens of a short text, by merging the best pair, the leftmost if tied, over and over."""
        parts, after = list(text), [*range(1, len(text)), -1]
        before = [n - 1 for n in range(len(text))]

        def pair(a: int, b: int):
            score = self.score.get(parts[a] + parts[b]) if a >= 0 and b >= 0 else None
            return None if score is None else (-score, a, b, parts[a], parts[b])

        heap = [p for n in range(len(parts) - 1) if (p := pair(n, n + 1))]
        heapify(heap)
        while heap:
            _, a, b, left, right = heappop(heap)
            if parts[a] != left or parts[b] != right or after[a] != b:
                continue
            parts[a], parts[b] = left + right, ""
            after[a] = after[b]
            if after[b] >= 0:
                before[after[b]] = a
            for p in (pair(before[a], a), pair(a, after[a])):
                if p:
                    heappush(heap, p)
        return [p for p in parts if p]

    def _fit(self, left: str | None, right: str) -> bool:
        if left is None or left[-1] + right[0] not in self.touching:
            return True
        if (left, right) not in self.fits:
            self.fits[left, right] = self._encoded(left + right) == [left, right]
        return self.fits[left, right]

    def _tokens(self, token: str) -> int:
        """A character without a piece becomes its bytes."""
        return 1 if token in self.score else len(token.encode())

    def _compile(self, state: int, c: str) -> tuple[int, int]:
        """Next state and emitted count of a transition."""
        going, last, count = [], c, None
        for token, node, before in self.starts[state]:
            if node is self.root:
                if token is not None and token[-1] + c not in self.touching:
                    token = None
                if c not in self.score and self._fit(token, c):
                    last, count = c, before + self._tokens(c)
            child = node.next.get(c)
            if child is not None:
                if child.is_piece and self._fit(token, child.text):
                    last, count = child.text, before + 1
                if child.next:
                    going.append((token, child, before))
        going = [(token, node, before - count) for token, node, before in going]
        move = self._state((*going, (last, self.root, 0))), count
        self.moves[state][c] = move
        return move

    def advance(self, state: int, marked: str) -> tuple[int, int]:
        """The state after reading more of a text, and the tokens emitted."""
        total, moves = 0, self.moves
        for c in marked:
            state, emitted = moves[state].get(c) or self._compile(state, c)
            total += emitted
        return state, total

    def segment(self, segment: str) -> int:
        """Tokens of what lies between two borders; those of short segments are remembered."""
        count = self.counts.get(segment)
        if count is None:
            if len(self.starts) > STATES:
                self._reset()
            count = self.advance(0, segment)[1]
            if len(segment) <= 64:
                if len(self.counts) >= SEGMENTS:
                    self.counts.clear()
                self.counts[segment] = count
        return count

    def marked(self, marked: str) -> int:
        """Tokens of a text that begins at a border, spaces as marks."""
        return sum(map(self.segment, _SEGMENT.findall(marked)))

    def count(self, text: str) -> int:
        """Tokens of a whole text."""
        return self.marked(MARK + text.replace(" ", MARK)) if text else 0

    def through(self, maps: list[ChunkMap]) -> int:
        """Tokens of the text whose chunks have these maps, the first entered at a border."""
        state, total = 0, 0
        for m in maps:
            state, emitted = self.advance(state, m.head)
            total += emitted
            if m.inner is not None:
                state, emitted = self.advance(0, m.tail)
                total += m.inner + emitted
        return total

    def chunk(self, chunk: str) -> ChunkMap:
        """The map of a part of a text, whatever state it is entered in."""
        marked = chunk.replace(" ", MARK)
        segments = _SEGMENT.findall(marked)
        if len(segments) < 2:
            return ChunkMap(marked, None, "")
        return ChunkMap(segments[0], sum(map(self.segment, segments[1:-1])), segments[-1])


@dataclass(frozen=True)
class ChunkMap:
    """What a chunk does to a state: ``head`` ends in the state that is open before, ``inner`` tokens
    follow, and ``tail`` is open after it. Without ``inner`` the chunk has no border: it is all head.

    A chunk may begin or end inside a segment, so its first and last segment are left open.
    """

    head: str
    inner: int | None
    tail: str

    def then(self, other: ChunkMap, machine: Transducer) -> ChunkMap:
        """Both maps, one after the other; grouping does not matter."""
        if self.inner is None and other.inner is None:
            return machine.chunk(self.head + other.head)
        if self.inner is None:
            first = machine.chunk(self.head + other.head)
            return ChunkMap(first.head, first.inner + machine.segment(first.tail) + other.inner, other.tail) if first.inner is not None else ChunkMap(first.head, other.inner, other.tail)
        last = machine.chunk(self.tail + other.head)
        if last.inner is None:
            middle, tail = 0, last.head
        else:
            middle, tail = machine.segment(last.head) + last.inner, last.tail
        if other.inner is None:
            return ChunkMap(self.head, self.inner + middle, tail)
        return ChunkMap(self.head, self.inner + middle + machine.segment(tail) + other.inner, other.tail)

    def closed(self, machine: Transducer) -> int:
        """Tokens when nothing comes before or after."""
        return machine.segment(self.head) + (0 if self.inner is None else self.inner + machine.segment(self.tail))


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    """The machine of a model, compiled once by each worker."""
    return Transducer(path)
