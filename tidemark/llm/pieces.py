"""SentencePiece encoding and decoding: distinct segmentations sampled without replacement.

A text's segmentations form a lattice. Their Gumbel-perturbed log-probabilities
are explored best first: a node stands for all segmentations with a common
prefix and carries the maximum of their perturbed scores, drawn top-down given
its parent's maximum. Popping the best node and following the child that
inherits its maximum ends in a segmentation; its siblings join the queue. The
first k segmentations popped are a sample of k without replacement, and the
queue's next score is the threshold their inclusion scores need.

Pieces never cross from a non-space to a space, so a lattice is a chain of
short lattices of chunks (spaces and the word after them). Lattices of the
distinct chunks of a batch are built at once as arrays, and all chunks of a
text draw their paths side by side, one step each at a time. A long chunk, such
as a text in a script without spaces, draws all its nodes at once instead and
then only follows the winners. Draws are keyed by position, so both ways give
the same path.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bound_batches, strings

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
SAMPLES = 2
SHARPNESS = 1.0
SEED = 17
SAMPLE = "struct<ids: array<int>, log_prob: double, perturbed: double, log_inclusion: double, round_trip: boolean>"
RESULT = f"array<{SAMPLE}>"

_STEP, _MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
_STRIDE = np.uint64(0xD1342543DE82EF95)
_TABLE_BITS = 19
_PART_CHUNKS = 40_000  # chunks whose descents run side by side
_LONG = 256  # characters from which a chunk is drawn by itself, all its nodes at once
_WINDOW = 1 << 15  # nodes of a long chunk drawn together
_HEAD = 16  # visited nodes whose siblings say how far a descent can have better ones
_LEAST = 38.0  # above minus the log of the least value of ``exponential``


@dataclass
class Vocabulary:
    """Pieces by id with their log-scores, and the ids of the 256 byte pieces. Its size is that of the model file.

    A merge model's file has ranks, not probabilities: a piece of rank r
    scores ``-sharpness * log(1 + r)``. Characters without a piece are written
    as their bytes, each at the score of the last rank.
    """

    pieces: list[bytes]
    ids: np.ndarray
    scores: np.ndarray
    bytes_: np.ndarray
    texts: list[str]
    byte_score: float

    @classmethod
    def load(cls, path: str = MODEL, sharpness: float = SHARPNESS) -> Vocabulary:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(size)]
        is_byte = [model.is_byte(i) for i in range(size)]
        bytes_ = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        ids = [i for i in range(size) if not special[i] and not is_byte[i]]
        texts = [model.id_to_piece(i).replace(SPACE, " ") for i in ids]
        crossing = [t for t in texts if "\n" in t or " " in t.lstrip(" ")]
        if crossing or not all(model.is_byte(int(b)) for b in bytes_):
            raise ValueError("the model needs byte pieces and no piece with a space or newline inside")
        if max(map(len, texts), default=0) > _LONG:
            raise ValueError(f"the model has a piece of more than {_LONG} characters")
        ranks = np.array([max(0.0, -model.get_score(i)) for i in ids])
        if len(ids) and ranks.max() < 100:  # a file with log-probabilities
            scores = -sharpness * ranks
        else:
            scores = -sharpness * np.log1p(ranks)
        pieces = [b""] * size
        for i, text in zip(ids, texts):
            pieces[i] = text.encode()
        for value, i in enumerate(bytes_):
            pieces[int(i)] = bytes([value])
        return cls(pieces, np.array(ids, np.int32), scores, bytes_, texts, float(scores.min(initial=0.0)) - sharpness)

    @cached_property
    def prefixes(self) -> tuple[np.ndarray, np.ndarray]:
        """Open-addressed table of all beginnings of pieces: keys, and the piece's index or -1."""
        sizes = np.array([len(t) for t in self.texts], np.int64)
        codes = np.frombuffer("".join(self.texts).encode("utf-32-le"), np.uint32).astype(np.uint64)
        first, key = np.cumsum(sizes) - sizes, np.zeros(len(sizes), np.uint64)
        parts = []
        for width in range(1, int(sizes.max(initial=0)) + 1):
            some = np.flatnonzero(sizes >= width)
            key[some] = key[some] * _STEP + codes[first[some] + width - 1] + np.uint64(1)
            parts.append((key[some], np.where(sizes[some] == width, some, -1)))
        known, number = np.unique(np.concatenate([np.zeros(0, np.uint64), *(k for k, _ in parts)]), return_inverse=True)
        index = np.full(len(known), -1, np.int64)
        np.maximum.at(index, number, np.concatenate([np.zeros(0, np.int64), *(i for _, i in parts)]))
        size = 1 << _TABLE_BITS
        keys, values = np.zeros(size, np.uint64), np.full(size, -1, np.int64)
        slot = (known * _MIX >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)
        waiting = np.arange(len(known))
        while len(waiting):  # the first of each free slot takes it, the others go on to the next slot
            free = waiting[keys[slot[waiting]] == 0]
            taken = free[np.unique(slot[free], return_index=True)[1]]
            keys[slot[taken]], values[slot[taken]] = known[taken], index[taken]
            waiting = waiting[keys[slot[waiting]] != known[waiting]]
            slot[waiting] = (slot[waiting] + 1) % size
        return keys, values

    @cached_property
    def spelt(self) -> pa.Array:
        """The bytes of every piece by id."""
        return pa.array(self.pieces, pa.large_binary())

    @cached_property
    def singles(self) -> np.ndarray:
        """Per code point the index of its piece, -1 where it only begins pieces, -2 where it begins none."""
        made = np.full(0x110000, -2, np.int64)
        made[[ord(t[0]) for t in self.texts]] = -1
        alone = [(ord(t), index) for index, t in enumerate(self.texts) if len(t) == 1]
        made[[code for code, _ in alone]] = [index for _, index in alone]
        return made

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the keys that begin a piece, and for each the index of the piece that it is, or -1."""
        keys, values = self.prefixes
        slot = (wanted * _MIX >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)
        found = keys[slot]
        begins = found == wanted
        astray = np.flatnonzero(~begins & (found != 0))
        while len(astray):
            slot[astray] = (slot[astray] + 1) % len(keys)
            found = keys[slot[astray]]
            begins[astray] = found == wanted[astray]
            astray = astray[(found != wanted[astray]) & (found != 0)]
        known = np.flatnonzero(begins)
        return known, values[slot[known]]


def distinct_chunks(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Per text the numbers of its chunks (a space stands before every text); characters and lengths of the distinct chunks.

    A chunk is a run of newlines, or spaces and the run of other characters
    after them. Chunks are told apart by 64-bit polynomial hashes.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    codes = np.frombuffer("".join(" " + t for t in texts).encode("utf-32-le"), np.uint32)
    first = np.zeros(len(codes), bool)
    first[np.cumsum(sizes) - sizes] = True
    kind = np.where(codes == 32, 1, np.where(codes == 10, 2, 0)).astype(np.int8)
    first[1:] |= (kind[1:] != kind[:-1]) & ~((kind[1:] == 0) & (kind[:-1] == 1))
    start = np.flatnonzero(first)
    length = np.diff(np.append(start, len(codes)))
    powers = np.cumprod(np.full(int(length.max()) + 1, _STEP, np.uint64))
    within = np.arange(len(codes)) - np.repeat(start, length)
    key = np.add.reduceat((codes.astype(np.uint64) + np.uint64(1)) * powers[within], start) * _MIX
    _, at, number = np.unique(key, return_index=True, return_inverse=True)
    chosen, size = start[at], length[at]
    picked = np.arange(int(size.sum())) + np.repeat(chosen - np.cumsum(size) + size, size)
    of_text = np.searchsorted(start, np.cumsum(sizes))
    return np.split(number, of_text[:-1]), codes[picked].astype(np.uint64), size


class Lattices:
    """Lattices of distinct chunks: one node per character, arcs grouped by the node they leave.

    ``log_p`` is an arc's log-probability given its node, ``limit`` the sum of the
    node's probabilities up to it in parts of 2^53 (without end for the last);
    ``ids`` its piece, or -1 - code point for a character written as several bytes.
    """

    def __init__(self, codes: np.ndarray, lengths: np.ndarray, vocabulary: Vocabulary):
        ends = np.cumsum(lengths)
        self.start, self.length = ends - lengths, lengths
        n = len(codes)
        left = np.repeat(ends, lengths) - np.arange(n)  # characters to the end of the chunk
        index = vocabulary.singles[codes.astype(np.int64)]
        # per length of a piece: the nodes it leaves, and its index (-1: the character's bytes)
        levels = [(np.arange(n), np.maximum(index, -1))]
        next_code = codes + np.uint64(1)
        alive, width = np.flatnonzero((index > -2) & (left > 1)), 1
        key = next_code[alive]
        while len(alive):
            key *= _STEP
            key += next_code[alive + width]
            width += 1
            known, index = vocabulary.find(key)
            alive, key = alive[known], key[known]
            whole = np.flatnonzero(index >= 0)
            levels.append((alive[whole], index[whole]))
            further = np.flatnonzero(left[alive] > width)
            alive, key = alive[further], key[further]
        # arcs lie by distance from the end, then by node, then by length
        order = np.argsort(left.astype(np.int16) if lengths.max(initial=0) < 1 << 15 else left, kind="stable")
        self.count = np.ones(n, np.int32)
        for source, _ in levels[1:]:
            self.count[source] += 1
        count = self.count[order]
        runs = np.cumsum(count) - count
        self.first = np.empty(n, np.int64)
        self.first[order] = runs
        total = int(count.sum())
        self.ids, self.target, score = np.empty(total, np.int32), np.empty(total, np.int32), np.empty(total)
        filled = self.first.copy()
        for width, (source, index) in enumerate(levels, 1):
            at = filled[source]
            filled[source] = at + 1
            score[at], self.ids[at] = vocabulary.scores[index], vocabulary.ids[index]
            self.target[at] = np.where(left[source] == width, -1, source + width)
            if width == 1 and (index < 0).any():
                bare, cell = source[index < 0], at[index < 0]
                code = codes[bare].astype(np.int64)
                n_bytes = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
                self.ids[cell] = np.where(n_bytes == 1, vocabulary.bytes_[np.minimum(code, 127)], -1 - code)
                score[cell] = vocabulary.byte_score * n_bytes
        del levels, filled
        # log-sums of all paths from a node to the end of its chunk, nearest nodes first
        sums = np.zeros(n + 1)  # the last stands for the end
        ends_at = np.append(runs, total)
        by_level = np.searchsorted(left[order], np.arange(1, min(int(left.max(initial=0)), _LONG) + 2)).tolist()
        for a, b in zip(by_level[:-1], by_level[1:]):
            low, high = int(ends_at[a]), int(ends_at[b])
            begin, some = runs[a:b] - low, count[a:b]
            below = score[low:high]
            below += sums[self.target[low:high]]
            top = np.maximum.reduceat(below, begin)
            below -= np.repeat(top, some)
            share = np.log(np.add.reduceat(np.exp(below), begin))
            sums[order[a:b]] = top + share
            below -= np.repeat(share, some)
        for chunk in np.flatnonzero(lengths > _LONG).tolist():
            self._sum_long(score, sums, int(self.start[chunk]), int(ends[chunk]) - _LONG)
        self.log_p = score
        # shares of 2^53 summed within each node; whole numbers, so that no other chunk has a say in their rounding
        share = np.exp(score)
        share *= 2.0**53
        self.limit = np.cumsum(share.astype(np.uint64))
        last = runs + count - 1
        self.limit -= np.repeat(np.append(np.zeros(1, np.uint64), self.limit[last[:-1]]), count)
        self.limit[last] = np.uint64(0xFFFFFFFFFFFFFFFF)

    def _sum_long(self, score: np.ndarray, sums: np.ndarray, start: int, stop: int) -> None:
        """The log-sums of a long chunk's nodes from ``stop`` back to ``start``, one after the other, window by window."""
        while stop > start:
            low = max(start, stop - _WINDOW)
            arcs = self.arcs_of(np.arange(low, stop))
            scores, ahead = score[arcs].tolist(), (self.target[arcs] - low).tolist()
            # sums of the window's nodes, then of those its last nodes reach
            known = sums[low:stop + _LONG].tolist()
            at = len(arcs)
            for node, count in zip(range(stop - low - 1, -1, -1), self.count[low:stop][::-1].tolist()):
                at -= count
                reached = [scores[k] + known[ahead[k]] for k in range(at, at + count)]
                top = max(reached)
                total = top + math.log(sum([math.exp(x - top) for x in reached]))
                known[node] = total
                scores[at:at + count] = [x - total for x in reached]
            score[arcs], sums[low:stop] = scores, known[:stop - low]
            stop = low

    def arcs_of(self, nodes: np.ndarray) -> np.ndarray:
        """The arcs of the nodes, one node's after the other's."""
        count = self.count[nodes]
        offset = np.cumsum(count) - count
        return np.repeat(self.first[nodes] - offset, count) + np.arange(int(count.sum()))

    def draw(self, salt: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Per node an arc drawn by the probabilities."""
        level = mixed(counters(salt, nodes)) >> np.uint64(11)
        arc = self.first[nodes]
        beyond = np.flatnonzero(level >= self.limit[arc])
        while len(beyond):
            arc[beyond] += 1
            beyond = beyond[level[beyond] >= self.limit[arc[beyond]]]
        return arc

    def rest(self, arc: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Per arc the probability of the other arcs of its node."""
        rest = 0.0 - np.expm1(self.log_p[arc])
        near = np.flatnonzero((rest < 1e-9) & (self.count[node] > 1))  # lost in rounding: summed
        if len(near):
            others, count = self.arcs_of(node[near]), self.count[node[near]]
            p = np.where(others == np.repeat(arc[near], count), 0.0, np.exp(self.log_p[others]))
            rest[near] = np.maximum(np.add.reduceat(p, np.cumsum(count) - count), 1e-300)
        return rest

    def follow(self, salt: np.uint64, node: int, end: int) -> np.ndarray:
        """The arcs of a long chunk's segmentation from ``node`` on: windows are drawn whole, then walked."""
        parts = []
        while node >= 0:
            nodes = np.arange(node, min(node + _WINDOW, end))
            chosen = self.draw(np.full(len(nodes), salt), nodes)
            target = self.target[chosen].tolist()
            low, walked = node, []
            while low <= node < low + len(target):
                walked.append(node - low)
                node = target[node - low]
            parts.append(chosen[walked])
        return np.concatenate(parts)


@dataclass
class Path:
    """A segmentation: per visited node its chunk's place, its arc and the log-probability before it."""

    place: np.ndarray
    arc: np.ndarray
    before: np.ndarray
    log_prob: float
    perturbed: float


@dataclass
class Search:
    """Where a descent starts: a text's chunks, the first chunk not begun, a node inside the one before (or -1)."""

    chunks: np.ndarray
    key: int
    prefix: Path | None
    next_place: int
    node: int
    log_prob: float
    perturbed: float


def counters(salt: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Counters of nodes, given the salts of their chunks (which count from the chunk's start)."""
    return salt + nodes.astype(np.uint64) * _STRIDE


def mixed(x: np.ndarray) -> np.ndarray:
    """Counters as random 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def exponential(counter: np.ndarray) -> np.ndarray:
    """Exponential variates of counters, whatever the order of the calls; never 0."""
    return -np.log(((mixed(counter) >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52)


def descend(searches: list[Search], lat: Lattices, wanted: int) -> list[tuple[Path, list[tuple[float, int, int]]]]:
    """Follow inherited maxima from every search's node to a segmentation; its siblings worth keeping.

    Arcs race by exponential times over probabilities, and the first inherits the
    maximum. That is an arc drawn by the probabilities; by memorylessness its lead
    over the next is an exponential time over the probability of all others, and
    the others race on from there. A sibling's perturbed score is
    ``-log(exp(-perturbed) + x)`` with x the lead it lost by, over the
    probability of the prefix; only the ``wanted`` best of a descent can ever be
    popped, and no lead makes up for a prefix ``exp(_LEAST)`` times less probable.
    Siblings are (score, number of the visited node, arc). Draws depend on the
    text's key, the chunk's place and the node's position in it alone.
    """
    inside = np.array([s.node >= 0 for s in searches])
    begin = np.array([s.next_place for s in searches]) - inside
    size = np.array([len(s.chunks) for s in searches]) - begin
    item = np.repeat(np.arange(len(searches)), size)
    lane_at = np.cumsum(size) - size
    place = np.arange(len(item)) - np.repeat(lane_at - begin, size)
    chunk = np.concatenate([s.chunks[b:] for s, b in zip(searches, begin)]) if len(item) else np.zeros(0, np.int64)
    origin = lat.start[chunk]
    end = origin + lat.length[chunk]
    start = origin.copy()
    start[lane_at[inside]] = [s.node for s in searches if s.node >= 0]
    key = np.array([s.key for s in searches], np.uint64)[item]
    salt = key + place.astype(np.uint64) * _MIX - origin.astype(np.uint64) * _STRIDE
    long = end - start > _LONG
    lane = np.flatnonzero(~long)
    nodes, own, steps = start[lane], salt[lane], []
    visits = np.zeros(len(item), np.int64)
    while len(nodes):
        chosen = lat.draw(own, nodes)
        steps.append((lane, chosen))
        target = lat.target[chosen]
        visits[lane[target < 0]] = len(steps)
        going = np.flatnonzero(target >= 0)
        nodes, lane, own = target[going], lane[going], own[going]
    walks = [(at, lat.follow(salt[at], int(start[at]), int(end[at]))) for at in np.flatnonzero(long).tolist()]
    for at, walked in walks:
        visits[at] = len(walked)
    first_visit = np.cumsum(visits) - visits
    total = int(visits.sum())
    arc = np.empty(total, np.int64)
    for number, (at, chosen) in enumerate(steps):
        arc[first_visit[at] + number] = chosen
    for at, walked in walks:
        arc[first_visit[at]:first_visit[at] + visits[at]] = walked
    visited = np.repeat(place, visits)
    gained = lat.log_p[arc]
    reached = np.cumsum(gained)
    of_item = np.append(first_visit, total)[np.append(lane_at, len(item))]
    done = np.concatenate([[0.0], reached])
    before = reached - gained + np.repeat(np.array([s.log_prob for s in searches]) - done[of_item[:-1]], np.diff(of_item))

    def leads(visit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of visits the nodes, their counters and the leads of the arcs drawn."""
        at = np.searchsorted(first_visit, visit, side="right") - 1
        node = np.where(visit == first_visit[at], start[at], lat.target[arc[visit - 1]])
        counter = counters(salt[at], node)
        with np.errstate(divide="ignore"):
            return node, counter, exponential(counter + np.uint64(1)) / lat.rest(arc[visit], node)

    def ranges(stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The visits of every search up to its stop, and where each search's begin among them."""
        size = stops - of_item[:-1]
        begins = np.cumsum(size) - size
        return np.arange(int(size.sum())) + np.repeat(of_item[:-1] - begins, size), np.append(begins, int(size.sum()))

    visit, begins = ranges(np.minimum(of_item[:-1] + max(_HEAD, wanted), of_item[1:]))
    worth = before[visit] - np.log(leads(visit)[2])
    stops = of_item[1:].copy()
    for n, (a, b) in enumerate(zip(begins[:-1].tolist(), begins[1:].tolist())):
        if b - a >= wanted:
            enough = np.partition(worth[a:b], b - a - wanted)[b - a - wanted]
            stops[n] = of_item[n] + np.searchsorted(-before[of_item[n]:of_item[n + 1]], _LEAST - enough, side="right")
    visit, begins = ranges(stops)
    node, counter, lead = leads(visit)
    worth = before[visit] - np.log(lead)
    picked, results = [], []
    for n, search in enumerate(searches):
        a, b = int(begins[n]), int(begins[n + 1])
        picked.append(np.argpartition(-worth[a:b], wanted - 1)[:wanted] + a if b - a > wanted else np.arange(a, b))
        a, b = int(of_item[n]), int(of_item[n + 1])
        parts = [visited[a:b], arc[a:b], before[a:b]]
        if search.prefix is not None:
            parts = [np.concatenate(x) for x in zip((search.prefix.place, search.prefix.arc, search.prefix.before), parts)]
        results.append((Path(*parts, search.log_prob + float(done[b] - done[a]), search.perturbed), []))
    # the races of the other arcs at the nodes that hold the best siblings
    near = np.concatenate(picked) if picked else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(searches)), [len(p) for p in picked])
    count = lat.count[node[near]]
    arcs, of, who = lat.arcs_of(node[near]), np.repeat(near, count), np.repeat(owner, count)
    number = np.arange(len(arcs)) - np.repeat(np.cumsum(count) - count, count)
    rival = np.flatnonzero(arcs != arc[visit[of]])
    arcs, of, who, number = arcs[rival], of[rival], who[rival], number[rival]
    times = exponential(counter[of] + (number + 2).astype(np.uint64) * _MIX) * np.exp(np.minimum(-lat.log_p[arcs], 700.0))
    count = count[count > 1] - 1
    least = np.minimum.reduceat(times, np.cumsum(count) - count) if len(times) else times
    value = before[visit[of]] - np.log(lead[of] + times - np.repeat(least, count))
    score = -np.logaddexp(-np.array([s.perturbed for s in searches])[who], -value)
    for n, points, at, one in zip(who.tolist(), score.tolist(), visit[of].tolist(), arcs.tolist()):
        held = 0 if searches[n].prefix is None else len(searches[n].prefix.arc)
        results[n][1].append((points, held + at - int(of_item[n]), one))
    for _, siblings in results:
        siblings.sort(reverse=True)
        del siblings[wanted:]
    return results


def sample_paths(chunks: list[np.ndarray], keys: list[int], lat: Lattices, k: int) -> list[tuple[list[Path], float]]:
    """Per text the ``k`` best segmentations by perturbed score (all, if there are fewer), and the next best score.

    All texts go side by side: one descent each from the root, then one from
    the best node of each queue, and so on.
    """
    roots = -np.log(exponential(np.array(keys, np.uint64)))
    searches = [Search(c, key ^ 0x5851F42D4C957F2D, None, 0, -1, 0.0, float(root)) for c, key, root in zip(chunks, keys, roots)]
    found: list[list[Path]] = [[] for _ in chunks]
    queues: list[list] = [[] for _ in chunks]
    live = list(range(len(chunks)))
    for turn in range(1, k + 1):
        for n, (path, siblings) in zip(live, descend(searches, lat, k)):
            found[n].append(path)
            for score, at, arc in siblings:
                heapq.heappush(queues[n], (-score, len(found[n]) - 1, at, arc))
        live = [n for n in live if queues[n]] if turn < k else []
        searches = []
        for n in live:
            score, parent, at, arc = heapq.heappop(queues[n])
            old = found[n][parent]
            place = int(old.place[at])
            prefix = Path(old.place[:at + 1], np.append(old.arc[:at], arc), old.before[:at + 1], 0.0, 0.0)
            searches.append(Search(chunks[n], (keys[n] + turn * 0x9FB21C651E98DF25) & 0xFFFFFFFFFFFFFFFF, prefix, place + 1,
                                   int(lat.target[arc]), float(old.before[at]) + float(lat.log_p[arc]), -score))
        if not live:
            break
    return [(paths, -queue[0][0] if queue else -np.inf) for paths, queue in zip(found, queues)]


def path_ids(path: Path, lattices: Lattices, vocabulary: Vocabulary) -> np.ndarray:
    """Piece ids of a segmentation; characters without a piece as the ids of their bytes."""
    ids = lattices.ids[path.arc]
    spread = np.flatnonzero(ids < 0)
    if not len(spread):
        return ids.astype(np.int32)
    made, at = [], 0
    for place in spread:
        made += [ids[at:place], vocabulary.bytes_[list(chr(-1 - int(ids[place])).encode())]]
        at = place + 1
    return np.concatenate([*made, ids[at:]]).astype(np.int32)


def log_inclusion(log_prob: float, threshold: float) -> float:
    """Log of the chance that a segmentation's perturbed score exceeds the threshold."""
    if threshold == -np.inf:
        return 0.0
    x = np.exp(min(log_prob - threshold, 700.0))
    return float(np.log(-np.expm1(-x))) if x > 1e-8 else float(log_prob - threshold)


def sample_batch(texts: list[str], keys: list, vocabulary: Vocabulary, k: int, seed: int) -> list[list[tuple]]:
    """Per text its samples as (ids, log_prob, perturbed, log_inclusion), best perturbed score first."""
    results: list[list[tuple]] = [[(np.zeros(0, np.int32), 0.0, 0.0, 0.0)] for _ in texts]
    if not any(texts):
        return results
    numbered, codes, lengths = distinct_chunks(texts)
    lattices = Lattices(codes, lengths, vocabulary)
    part: list[int] = []
    held = 0
    for n, chunks in enumerate(numbered):
        if texts[n]:
            part.append(n)
            held += len(chunks)
        if part and (held >= _PART_CHUNKS or n + 1 == len(texts)):
            seeds = [xxhash.xxh64_intdigest(str(keys[i]), seed) for i in part]
            for i, (paths, threshold) in zip(part, sample_paths([numbered[i] for i in part], seeds, lattices, k)):
                results[i] = [(path_ids(p, lattices, vocabulary), p.log_prob, p.perturbed, log_inclusion(p.log_prob, threshold))
                              for p in paths]
            part, held = [], 0
    return results


def decode(ids, pieces: list[bytes]) -> str:
    """The text of a segmentation: its pieces and bytes joined, without the space put before every text."""
    return b"".join(map(pieces.__getitem__, ids)).decode("utf-8", "replace")[1:]


def sample_segmentations(text: str | Column, key: str | Column, vocabulary: Vocabulary, k: int = SAMPLES,
                         seed: int = SEED) -> Column:
    """Array column of up to ``k`` distinct segmentations of the whole text, drawn without replacement.

    Each has its piece ids, log-probability, perturbed score, log inclusion
    score and whether its ids decode to the text, best perturbed score first. Draws depend on ``key``, the text and
    ``seed`` alone, so repeated rows get equal samples. A null or empty text has
    one segmentation, without pieces; a null key counts as the word None.
    """

    @F.arrow_udf(RESULT)
    def of(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, keys in batches:
            whole = strings(texts)
            yield samples_array(sample_batch(whole, keys.to_pylist(), vocabulary, k, seed), whole, vocabulary.spelt)

    return of(text, key)


def samples_array(rows: list[list[tuple]], texts: list[str], pieces: pa.Array) -> pa.Array:
    """The samples of every text as ``SAMPLE`` structs, each decoded and held against its text byte by byte."""
    flat = [sample for row in rows for sample in row]
    ids = np.concatenate([s[0] for s in flat]) if flat else np.zeros(0, np.int32)
    offsets = pa.array(np.concatenate([[0], np.cumsum([len(s[0]) for s in flat])]).astype(np.int32))
    made = pc.binary_join(pa.ListArray.from_arrays(offsets, pieces.take(pa.array(ids))), pa.scalar(b"", pa.large_binary()))
    # a text without pieces is empty, any other has a space before it
    whole = [b" " + text.encode() if text else b"" for text, row in zip(texts, rows) for _ in row]
    parts = [pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))]
    parts += [pa.array(np.array([s[n] for s in flat], np.float64)) for n in (1, 2, 3)]
    parts.append(pc.equal(made, pa.array(whole, pa.large_binary())))
    inner = pa.StructArray.from_arrays(parts, names=["ids", "log_prob", "perturbed", "log_inclusion", "round_trip"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)), inner)


def decoded(ids: str | Column, vocabulary: Vocabulary) -> Column:
    """The text of an ``array<int>`` column of piece ids; null for null."""
    pieces = vocabulary.pieces

    @F.arrow_udf("string")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([None if i is None else decode(i, pieces) for i in batch.to_pylist()], pa.string())

    return of(ids)


def encode_documents(docs: DataFrame, vocabulary: Vocabulary | None = None, k: int = SAMPLES, seed: int = SEED) -> DataFrame:
    """One row per document and sample: ``doc_id, sample, ids, log_prob, perturbed, log_inclusion, round_trip``.

    Samples of a document are distinct and numbered from 1; a text with fewer
    than ``k`` segmentations has them all. Repeated and null ids keep their
    rows; further columns are ignored; no rows give no rows.
    """
    bound_batches(docs.sparkSession)
    vocabulary = vocabulary or Vocabulary.load()
    sampled = docs.select("doc_id", sample_segmentations(F.col("text"), F.col("doc_id"), vocabulary, k, seed).alias("samples"))
    # no text is without a sample; the outer form spares Spark's filter on the array, which would draw all samples twice
    one = sampled.select("doc_id", F.posexplode_outer("samples").alias("at", "sample"))
    return one.select("doc_id", (F.col("at") + 1).alias("sample"), "sample.ids", "sample.log_prob", "sample.perturbed",
                      "sample.log_inclusion", "sample.round_trip")
