"""SentencePiece encoding and decoding with segmentations sampled without replacement.

A text's segmentations are the paths of a lattice; a path's probability is the product of its pieces'.
The k paths with the largest Gumbel-perturbed log-probabilities are k samples without replacement. They
are found top down: a set of paths has the perturbed value of its best member, which is a Gumbel draw
at the log of the set's mass, capped by the value of the set it was split from. Taking the set with the
largest value off a queue, one follows a random path through it; at each lattice node the paths that
leave by other pieces become a set of their own, with a value below the cap. As the masses of all sets
are exact (sums over the lattice from its end), the heuristic of this A* search is perfect: every walk
ends in the next sample, and none is thrown away. The value of the best set that is left after k samples
gives each sample's inclusion probability 1 - exp(-exp(log p - kappa)).

Randomness comes from a hash of the row's key, the sample, the word and the step, so a row has the same
samples wherever it is computed.

Pieces don't cross a blank or a line end, so a text's lattice is a chain of words' lattices. Those of a
batch's distinct words are built together, words of one length at a time; walks go through all words of
all texts at once, one piece per step.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tune

BLANK = "▁"
SAMPLES = 2
#: Exponent of the probabilities: below 1, samples differ more from the best segmentation.
ALPHA = 0.5
#: Characters of the texts that are sampled together.
TOGETHER = 2_500_000

#: Words of at most so many characters have masses that doubles hold as they are.
PLAIN = 60
#: So few walks are stepped through number by number, as arrays of a few cost more.
FEW = 8
#: Sets of paths are split off a path's first so many edges; more are looked at where these aren't enough.
WINDOW = 384

_WORD = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")
_LITERAL = f"_{BLANK}"  # stands for a blank sign that is in the text itself; no other word ends in one after a letter
_NO_CHAR = 0xFFFFFFFF
_U = np.uint64
_ALL = (1 << 64) - 1
_BASE, _SPREAD = 0x9E3779B97F4A7C15, _U(0xD1342543DE82EF95)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def _uniform(x: np.ndarray) -> np.ndarray:
    """In (0, 1), from hashes."""
    return ((_mix(x) >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53


@dataclass
class Vocabulary:
    """What encoding needs of a model; it is small, and goes to the executors as it is."""

    pieces: list[str]  # by id; byte pieces are <0x00> to <0xFF>
    log_prob: np.ndarray  # by id; nan for what no lattice has
    byte_id: np.ndarray

    @classmethod
    def load(cls, path: str, alpha: float = ALPHA) -> Vocabulary:
        """A unigram model's scores are log-probabilities. A BPE model's are minus the merge ranks, which
        follow Zipf's law: piece r has a probability in proportion to 1 / (r + 2)."""
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        score = np.array([sp.get_score(i) for i in range(n)])
        special = np.array([sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i) for i in range(n)])
        crossing = np.array([BLANK in p.lstrip(BLANK) or "\n" in p for p in pieces])
        if (score == np.round(score)).all() and score.min() < -n / 2:
            rank = np.where(special, 0, -score)
            rank = np.argsort(np.argsort(rank + np.where(special, 10.0**12, 0)))
            score = -np.log(rank + 2.0)
        log_prob = np.where(special | crossing, np.nan, score)
        log_prob = alpha * (log_prob - np.log(np.nansum(np.exp(log_prob))))
        byte_id = np.full(256, -1)
        for i in range(n):
            if sp.is_byte(i):
                byte_id[int(pieces[i][3:5], 16)] = i
        if (byte_id < 0).any():
            raise ValueError("the model has no byte pieces, so not every text can be encoded")
        log_prob[byte_id] = np.nanmin(log_prob) - alpha
        return cls(pieces, log_prob, byte_id)

    def tables(self) -> Tables:
        return Tables(self)

    def decoder(self) -> Decoder:
        return Decoder(self)


class Decoder:
    """ids to text; the inverse of encoding, for any text."""

    def __init__(self, v: Vocabulary):
        self.bytes = {int(i): bytes([b]) for b, i in enumerate(v.byte_id)}
        self.text = [p.replace(BLANK, " ") for p in v.pieces]
        for b in range(128):  # a whole character
            self.text[int(v.byte_id[b])] = chr(b)
        self.partial = np.zeros(len(v.pieces), bool)
        self.partial[v.byte_id[128:]] = True
        self.raw = pa.array([self.bytes.get(i) or p.encode() for i, p in enumerate(self.text)], pa.large_binary())

    def __call__(self, ids: np.ndarray) -> str:
        text = self.text
        if not self.partial[ids].any():
            out = "".join([text[i] for i in ids.tolist()])
        else:
            out = b"".join([self.bytes[i] if i in self.bytes else text[i].encode() for i in ids.tolist()]).decode("utf-8", "replace")
        return out[1:] if out.startswith(" ") else out

    def utf8(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The UTF-8 bytes of several texts, whose ids lie one after the other."""
        each = self.raw.take(pa.array(ids))
        at = np.frombuffer(each.buffers()[1], np.int64)[: len(ids) + 1][ends].tolist()
        data = each.buffers()[2].to_pybytes() if at and at[-1] else b""
        return [data[a + (data[a : a + 1] == b" ") : b] for a, b in zip([0, *at[:-1]], at, strict=True)]


def words_of(text: str) -> list[str]:
    """The words that the lattice of a text is a chain of; a blank begins the text, and each space is one."""
    if not text:
        return []
    out: list[str] = []
    for i, part in enumerate(text.split(BLANK)):
        if i:
            out.append(_LITERAL)
        for j, line in enumerate(part.split("\n")):
            if j:
                out.append("\n")
            if not i and not j:
                line = f" {line}"
            out += _WORD.findall(line.replace(" ", BLANK))
    return out


def all_words(texts: list[str]) -> tuple[pa.StringArray, np.ndarray]:
    """The words of words_of() of all texts, and how many each text has."""
    if any("\0" in text for text in texts):
        each = [words_of(text) for text in texts]
        return pa.array([w for ws in each for w in ws], pa.string()), np.fromiter(map(len, each), np.int64, len(each))
    plain = lambda x: BLANK not in x and "  " not in x and x[:1] not in ("", " ")
    marked = [(BLANK + x).replace(" ", f"\0{BLANK}").replace("\n", "\0\n\0") if plain(x) else "\0".join(words_of(x)) for x in texts]
    parts = pc.split_pattern(pa.array(marked, pa.string()), "\0")
    words = parts.flatten()
    there = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    count = np.diff(np.concatenate(([0], np.cumsum(there)))[parts.offsets.to_numpy()])
    return words.filter(pa.array(there)), count


class Tables:
    """The pieces and all that they begin with, by hash: a trie whose nodes are entries of a hash table."""

    def __init__(self, v: Vocabulary):
        self.byte_prob = float(np.exp(v.log_prob[v.byte_id[0]]))
        self.byte_id = v.byte_id.astype(np.int32)
        is_byte = np.zeros(len(v.pieces), bool)
        is_byte[v.byte_id] = True
        number: dict[str, int] = {}
        for i in np.flatnonzero(~np.isnan(v.log_prob) & ~is_byte).tolist():
            for n in range(1, len(v.pieces[i])):
                number.setdefault(v.pieces[i][:n], -1)
            number[v.pieces[i]] = i
        self.longest = max(map(len, number))
        self.power = [_U(pow(_BASE, j, 1 << 64)) for j in range(self.longest)]
        begins = sorted(number, key=len)
        self.piece = np.array([number[p] for p in begins], np.int32)
        self.prob = np.where(self.piece >= 0, np.exp(v.log_prob[self.piece]), 0.0)
        self.hash = np.array([sum((ord(c) + 1) * int(x) for c, x in zip(p, self.power, strict=False)) % (1 << 64) for p in begins], _U)
        goes_on = {p[:-1] for p in begins}
        self.goes_on = np.array([p in goes_on for p in begins])
        # A slot holds the first entry that falls in it; the few others are found by binary search.
        self.first = np.full(1 << 20, -1, np.int32)
        slot = self.slot(self.hash)
        self.first[slot[::-1]] = np.arange(len(slot), dtype=np.int32)[::-1]
        late = np.flatnonzero(self.first[slot] != np.arange(len(slot)))
        self.late = late[np.argsort(self.hash[late])]
        self.late_hash = np.append(self.hash[self.late], _U((1 << 64) - 1))

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are in the table, and at what entry."""
        at = self.first[self.slot(h)]
        maybe = np.flatnonzero(at >= 0)
        at = at[maybe]
        hit = self.hash[at] == h[maybe]
        wrong = np.flatnonzero(~hit)
        if len(wrong) and len(self.late):
            k = self.late[np.minimum(np.searchsorted(self.late_hash, h[maybe[wrong]]), len(self.late) - 1)]
            at[wrong] = k
            hit[wrong] = self.hash[k] == h[maybe[wrong]]
        return maybe[hit], at[hit]

    @staticmethod
    def slot(h: np.ndarray) -> np.ndarray:
        return (h * _SPREAD) >> _U(44)


class Lattice:
    """The lattices of distinct words. Nodes are places between characters; a word's last node has no edge.

    root: each word's first node. By node: start and n of its edges. By edge: source, target, piece (-1: several
    bytes of one character), its share q of the source's mass, the others' share, and the running sum
    of shares.
    """

    def __init__(self, words: pa.StringArray, t: Tables):
        length = pc.utf8_length(words).to_numpy().astype(np.int64)
        literal = pc.equal(words, _LITERAL)
        if pc.any(literal).as_py():
            words = pc.if_else(literal, "\0", words)
            length[literal.to_numpy(zero_copy_only=False)] = 1
        order = np.argsort(length, kind="stable")
        lit = literal.to_numpy(zero_copy_only=False)[order]
        in_order = words.take(pa.array(order))
        raw = in_order.buffers()[2]
        size = int(np.frombuffer(in_order.buffers()[1], np.int32)[len(order)])
        every = np.frombuffer(str(memoryview(raw)[:size], "utf-8").encode("utf-32-le"), np.uint32).copy() if size else np.zeros(0, np.uint32)
        length = length[order]
        every[(np.cumsum(length) - length)[lit]] = _NO_CHAR
        self.root = np.zeros(len(words), np.int64)
        parts: list[tuple[np.ndarray, ...]] = []
        self.char: list[np.ndarray] = []
        nodes = edges = used = 0
        groups = np.flatnonzero(np.diff(length, append=-1)) + 1
        at = 0
        for end in groups.tolist():
            n = int(length[at])
            while at < end:
                part = order[at : min(end, at + max(1, 200_000 // n))]
                chars = np.ascontiguousarray(every[used : used + n * len(part)].reshape(len(part), n).T)
                self.root[part] = nodes + np.arange(len(part))
                parts.append(self._edges(chars, nodes, t))
                self.char.append(np.pad(chars, ((0, 1), (0, 0))).ravel())
                nodes, edges = nodes + len(part) * (n + 1), edges + len(parts[-1][0])
                at, used = at + len(part), used + n * len(part)
        joined = lambda k, kind: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, kind)
        self.source, self.target, self.piece = joined(0, np.int64), joined(1, np.int64), joined(2, np.int64)
        self.q, self.rest, self.upto, self.n = joined(3, float), joined(4, float), joined(5, float), joined(6, np.int64)
        self.start = np.cumsum(self.n) - self.n
        self.char_at = np.concatenate(self.char) if self.char else np.zeros(0, np.uint32)

    @staticmethod
    def _edges(chars: np.ndarray, first: int, t: Tables) -> tuple[np.ndarray, ...]:
        """The edges of words of one length, given as columns of chars. The node before character i of word w is first + i * words + w."""
        n, c = chars.shape
        x = (chars.astype(_U) + _U(1)).ravel()
        alive, h = np.arange(n * c), x
        hits = []
        for size in range(1, min(n, t.longest) + 1):
            if size > 1:
                # Only where a longer piece begins so, and the word goes on.
                more = (alive < (n - size + 1) * c) & t.goes_on[entry]
                alive = alive[more]
                h = h[more] + x[alive + (size - 1) * c] * t.power[size - 1]
            found, entry = t.find(h)
            alive, h = alive[found], h[found]
            if not len(alive):
                break
            is_piece = np.flatnonzero(t.piece[entry] >= 0)
            hits.append((size, alive[is_piece], t.piece[entry[is_piece]], t.prob[entry[is_piece]]))
        alone = np.ones(n * c, bool)
        if hits and hits[0][0] == 1:
            alone[hits[0][1]] = False
        alone = np.flatnonzero(alone)
        if len(alone):
            char = chars.ravel()[alone]
            wide = 1 + (char >= 0x80).astype(np.int64) + (char >= 0x800) + (char >= 0x10000)
            wide[char == _NO_CHAR] = 3
            hits.insert(0, (1, alone, np.where(wide == 1, t.byte_id[char & 127], -1), t.byte_prob**wide))
        per = np.zeros(n * c, np.int64)
        for _, place, _, _ in hits:
            per[place] += 1
        begin = np.cumsum(per) - per
        fill, total = begin.copy(), int(per.sum())
        size, piece, q = np.empty(total, np.int64), np.empty(total, np.int32), np.empty(total)
        for k, place, ids, p in reversed(hits):  # longest first
            at = fill[place]
            size[at], piece[at], q[at] = k, ids, p
            fill[place] += 1
        source = np.repeat(np.arange(n * c), per)
        target = source + size * c
        if c == 1 and n > PLAIN:
            Lattice._shares_of_one(n, q, size, begin, per)
        else:
            Lattice._shares(n, c, q, source, target, begin)
        run = np.cumsum(q)
        upto = run - (run[begin] - q[begin])[source]
        upto[begin + per - 1] = 2.0  # above any draw
        rest = np.maximum(1.0 - q, 1e-300)
        rest[begin[per == 1]] = 0.0
        return source + first, target + first, piece, q, rest, upto, np.concatenate((per, np.zeros(c, np.int64)))

    @staticmethod
    def _shares(n: int, c: int, q: np.ndarray, source: np.ndarray, target: np.ndarray, begin: np.ndarray) -> None:
        """q, the pieces' probabilities, become shares of the mass of all paths from each place to the end."""
        mass = np.ones((n + 1) * c)
        scale = np.zeros((n + 1) * c) if n > PLAIN else None  # in long words each place has a scale of its own
        ends = np.append(begin[::c], len(q)).tolist()
        for i in range(n - 1, -1, -1):
            a, b = ends[i], ends[i + 1]
            here, there, s = source[a:b], target[a:b], q[a:b]
            if scale is None:
                s *= mass[there]
                mass[i * c : (i + 1) * c] = m = np.add.reduceat(s, begin[i * c : (i + 1) * c] - a)
            else:
                s *= np.exp(scale[there] - scale[here + c])
                m = np.add.reduceat(s, begin[i * c : (i + 1) * c] - a)
                scale[i * c : (i + 1) * c] = scale[(i + 1) * c : (i + 2) * c] + np.log(m)
            s /= m[here - i * c]

    @staticmethod
    def _shares_of_one(n: int, q: np.ndarray, size: np.ndarray, begin: np.ndarray, per: np.ndarray) -> None:
        """_shares for one long word: steps over numbers are cheaper than over arrays of one."""
        p, of, ends = q.tolist(), size.tolist(), (begin + per).tolist()
        scale = [0.0] * (n + 1)
        e = len(p)
        for i in range(n - 1, -1, -1):
            first = ends[i - 1] if i else 0
            near = scale[i + 1]
            m = 0.0
            for j in range(first, e):
                p[j] *= math.exp(scale[i + of[j]] - near)
                m += p[j]
            for j in range(first, e):
                p[j] /= m
            scale[i] = near + math.log(m)
            e = first
        q[:] = p

    def walk(self, node: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Random paths from nodes to their words' ends: the edges, one path after the other, and each path's length."""
        live = np.flatnonzero(self.n[node] > 0)
        at, key = node[live], seed[live]
        count = np.zeros(len(node), np.int64)
        steps = []
        while len(live) > FEW:
            u = _uniform(key + _U(len(steps) * int(_SPREAD) % (1 << 64)))
            e = self.start[at]
            late = np.flatnonzero(self.upto[e] <= u)
            while len(late):
                e[late] += 1
                late = late[self.upto[e[late]] <= u[late]]
            steps.append((live, e))
            count[live] += 1
            at = self.target[e]
            more = self.n[at] > 0
            live, at, key = live[more], at[more], key[more]
        alone = [self._walk_one(int(a), int(k), len(steps)) for a, k in zip(at, key, strict=True)]
        count[live] += np.array([len(x) for x in alone], np.int64)
        begin = np.cumsum(count) - count
        out = np.zeros(int(count.sum()), np.int64)
        for i, x in zip(live.tolist(), alone, strict=True):
            out[begin[i] + len(steps) : begin[i] + len(steps) + len(x)] = x
        for j, (i, e) in enumerate(steps):
            out[begin[i] + j] = e
        return out, count


    def _walk_one(self, at: int, key: int, step: int) -> list[int]:
        """walk() from one node, from that step on: the same draws, by numbers."""
        out = []
        n, start, target, upto = self.n, self.start, self.target, self.upto
        while n[at]:
            x = (key + step * int(_SPREAD)) & _ALL
            for _ in range(2):
                x = ((x ^ (x >> 32)) * 0xD6E8FEB86659FD93) & _ALL
            u = (((x ^ (x >> 32)) >> 11) + 0.5) * 2.0**-53
            e = int(start[at])
            while upto[e] <= u:
                e += 1
            out.append(e)
            at, step = int(target[e]), step + 1
        return out


def _capped(at: np.ndarray, cap: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Gumbel draws at the log masses at, under the condition of being at most cap."""
    with np.errstate(divide="ignore", over="ignore", invalid="ignore"):
        return np.where(np.isneginf(at), -np.inf, at - np.log(np.exp(at - cap) - np.log(u)))


@dataclass
class Sample:
    edges: np.ndarray
    log_prob: float
    gumbel: float


def sample_batch(texts: list[str], keys: np.ndarray, t: Tables, k: int = SAMPLES) -> tuple[Lattice, list[list[Sample]], np.ndarray]:
    """The k samples of each text, fewer where it has fewer segmentations, and each text's kappa."""
    words, count = all_words(texts)
    coded = words.dictionary_encode()
    lattice = Lattice(coded.dictionary, t)
    root = lattice.root[coded.indices.to_numpy()]
    begin = np.cumsum(count) - count
    docs = len(texts)
    seeds = _mix(keys.astype(np.int64).view(_U) * _U(2) + _U(1))
    found: list[list[Sample]] = [[] for _ in texts]
    queue: list[list[tuple]] = [[] for _ in texts]
    for r in range(k):
        salt = _mix(seeds + _U((r + 1) * _BASE % (1 << 64)))
        u = _uniform(salt)
        prefix: list[np.ndarray] = []
        gone: list[tuple[int, ...]] = [()] * docs  # edges already taken at the node where the path leaves another
        cap = np.full(docs, -np.inf)
        starts, first_word, who = [], [], []
        for d in range(docs):
            if r == 0:
                cap[d] = -np.log(-np.log(u[d]))
                prefix.append(root[:0])
                who.append(d)
                starts.append(root[begin[d] : begin[d] + count[d]])
                first_word.append(0)
            elif queue[d]:
                value, p, j, taken = heapq.heappop(queue[d])
                cap[d] = -value
                old = found[d][p].edges
                node = int(lattice.source[old[j]])
                choice = [e for e in range(int(lattice.start[node]), int(lattice.start[node] + lattice.n[node])) if e not in taken]
                q = np.cumsum(lattice.q[choice])
                e = choice[min(int(np.searchsorted(q, u[d] * q[-1], "right")), len(choice) - 1)]
                prefix.append(np.append(old[:j], e))
                gone[d] = taken
                word = int((lattice.n[lattice.target[old[:j]]] == 0).sum())
                who.append(d)
                starts.append(np.concatenate(([lattice.target[e]], root[begin[d] + word + 1 : begin[d] + count[d]])))
                first_word.append(word)
        if not who:
            break
        sizes = np.array([len(s) for s in starts])
        node = np.concatenate(starts)
        place = np.arange(len(node)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(first_word, sizes)
        edges, n = lattice.walk(node, _mix(np.repeat(salt[who], sizes) + place.astype(_U) * _SPREAD))
        ends = np.concatenate(([0], np.cumsum(n)))[np.concatenate(([0], np.cumsum(sizes)))]
        paths = [np.concatenate((p, edges[a:b])) for p, a, b in zip(prefix, ends[:-1], ends[1:], strict=True)]
        _split(lattice, who, paths, [len(p) for p in prefix], gone, cap, salt, found, queue, k - r)
    kappa = np.array([-q[0][0] if q else -np.inf for q in queue])
    return lattice, found, kappa


def _split(lattice: Lattice, who: list[int], paths: list[np.ndarray], kept: list[int], gone: list[tuple[int, ...]], cap: np.ndarray, salt: np.ndarray, found: list, queue: list, most: int) -> None:
    """Adds each path as a sample, and the sets of paths that leave it to its queue: no more of them than can still be asked for."""
    size = np.array([len(p) for p in paths])
    every = np.concatenate(paths)
    first = np.cumsum(size) - size
    log_q = np.log(lattice.q[every])
    total = np.zeros(len(who))
    total[size > 0] = np.add.reduceat(log_q, first[size > 0]) if len(every) else 0.0
    fork = np.array(kept) - 1  # the last given edge; sets before it are in the queue already
    # A draw adds at most 38 to its set's log mass, and takes off at most 4. So with enough sets within e^-15 of the
    # fork's mass, those below e^-58 of it can't be among the best.
    seen = np.minimum(size, WINDOW)
    while True:
        begin = np.cumsum(seen) - seen
        owner = np.repeat(np.arange(len(who)), seen)
        place = np.arange(len(owner)) - begin[owner]
        edge = first[owner] + place
        own = log_q[edge]
        run = np.cumsum(own)
        before = run - own - np.concatenate(([0.0], run))[begin][owner]
        base = np.zeros(len(who))
        forked = (fork >= 0) & (seen > 0)
        base[forked] = before[begin[forked] + np.minimum(fork, seen - 1)[forked]]
        edge = every[edge]
        rest = lattice.rest[edge]
        below = before - base[owner]
        enough = np.bincount(owner[(below > -8) & (rest > 1e-3) & (place > fork[owner])], minlength=len(who)) >= most
        short = seen < size
        short[short] = ~enough[short] | (below[begin[short] + seen[short] - 1] > -58)
        if not short.any():
            break
        seen = np.where(short, np.minimum(size, 4 * seen), seen)
    near = np.flatnonzero(((below > -58) | ~enough[owner]) & (place >= fork[owner]))
    edge, owner, place, before_near = edge[near], owner[near], place[near], before[near]
    with np.errstate(divide="ignore"):
        at = before_near + np.log(rest[near])
    begin = np.searchsorted(owner, np.arange(len(who) + 1))
    for i, d in enumerate(who):
        x = int(begin[i])  # the fork, if it is near
        if gone[d] and x < begin[i + 1] and place[x] == fork[i]:
            e = int(edge[x])
            node = int(lattice.source[e])
            others = [o for o in range(int(lattice.start[node]), int(lattice.start[node] + lattice.n[node])) if o not in gone[d] and o != e]
            at[x] = before_near[x] + np.log(lattice.q[others].sum()) if others else -np.inf
    docs = np.array(who)
    value = _capped(at, cap[docs][owner], _uniform(salt[docs][owner] ^ _mix(place.astype(_U) + _U(1 << 40))))
    for i, d in enumerate(who):
        found[d].append(Sample(paths[i], float(total[i]), float(cap[d])))
    filled = np.flatnonzero(np.diff(begin))
    for _ in range(most):
        if not len(filled):
            break
        top = np.full(len(who), np.nan)
        top[filled] = np.maximum.reduceat(value, begin[filled])
        hit = np.flatnonzero((value == top[owner]) & ~np.isneginf(value))
        _, one = np.unique(owner[hit], return_index=True)
        for x in hit[one].tolist():
            i = int(owner[x])
            d, j = who[i], int(place[x])
            taken = (gone[d] if j == fork[i] else ()) + (int(edge[x]),)
            heapq.heappush(queue[d], (-float(value[x]), len(found[d]) - 1, j, taken))
        value[hit[one]] = -np.inf


def _ids(lattice: Lattice, edges: np.ndarray, v: Vocabulary) -> np.ndarray:
    ids = lattice.piece[edges]
    odd = np.flatnonzero(ids < 0)
    if not len(odd):
        return ids
    chars = lattice.char_at[lattice.source[edges[odd]]].tolist()
    raw = [(BLANK if c == _NO_CHAR else chr(c)).encode("utf-8", "surrogatepass") for c in chars]
    out, last = [], 0
    for at, b in zip(odd.tolist(), raw, strict=True):
        out += [ids[last:at], v.byte_id[np.frombuffer(b, np.uint8)]]
        last = at + 1
    return np.concatenate([*out, ids[last:]])


def encode_samples(texts: list[str], keys: list[int], v: Vocabulary, t: Tables, k: int = SAMPLES) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each text its samples in falling perturbed order: ids, log-probability, perturbed value, log inclusion probability."""
    lattice, found, kappa = sample_batch(texts, np.array(keys, np.int64), t, k)
    out = []
    for samples, limit in zip(found, kappa.tolist(), strict=True):
        rows = []
        for s in samples:
            x = s.log_prob - limit
            with np.errstate(over="ignore"):
                inclusion = 0.0 if np.isinf(x) else float(x + np.log(-np.expm1(-np.exp(x)) / np.exp(x))) if x > -30 else float(x)
            rows.append((_ids(lattice, s.edges, v), s.log_prob, s.gumbel, min(inclusion, 0.0)))
        out.append(rows)
    return out


def sampled(docs: DataFrame, model: str, k: int = SAMPLES, alpha: float = ALPHA) -> DataFrame:
    """(doc_id, sample, n_pieces, ids, log_prob, gumbel, log_inclusion, round_trip): k rows per row of docs (doc_id, text, ...).

    sample counts from 0 in falling perturbed order; samples of a row differ. A text with fewer than k
    segmentations has them all, each with inclusion probability 1. A null text is the empty one, which has
    one segmentation, of no pieces. A null doc_id is the key 0. Rows with one key and text get the same
    samples. round_trip says whether ids decode to the text. An empty table gives no rows.
    """
    spark = docs.sparkSession
    tune(spark, 768)
    known = Vocabulary.load(model, alpha)
    shared = spark.sparkContext.broadcast((known.pieces, known.log_prob, known.byte_id))  # as large as the model's vocabulary
    schema = pa.schema([("doc_id", pa.int64()), ("sample", pa.int32()), ("n_pieces", pa.int64()), ("ids", pa.list_(pa.int32())), ("log_prob", pa.float64()), ("gumbel", pa.float64()), ("log_inclusion", pa.float64()), ("round_trip", pa.bool_())])

    def rows_of(ids: list, texts: list[str], v: Vocabulary, t: Tables, decode: Decoder) -> pa.RecordBatch:
        rows, whole = [], []
        for i, text, samples in zip(ids, texts, encode_samples(texts, [i or 0 for i in ids], v, t, k), strict=True):
            raw = text.encode()
            for j, s in enumerate(samples):
                rows.append((i, j, len(s[0]), s[0], s[1], s[2], s[3]))
                whole.append(raw)
        columns = list(zip(*rows, strict=True))
        ends = np.cumsum(columns[2])
        values = np.concatenate(columns[3]).astype(np.int32)
        columns[3] = pa.LargeListArray.from_arrays(pa.array(np.concatenate(([0], ends))), pa.array(values)).cast(pa.list_(pa.int32()))
        columns.append([a == b for a, b in zip(decode.utf8(values, ends), whole, strict=True)])
        return pa.RecordBatch.from_arrays([c if f.name == "ids" else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(*shared.value)
        t, decode = v.tables(), v.decoder()
        for b in batches:
            ids, texts = b.column("doc_id").to_pylist(), [x or "" for x in b.column("text").to_pylist()]
            at = 0
            while at < len(texts):
                to, chars = at + 1, len(texts[at])
                while to < len(texts) and chars + len(texts[to]) <= TOGETHER:
                    chars += len(texts[to])
                    to += 1
                yield rows_of(ids[at:to], texts[at:to], v, t, decode)
                at = to

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, sample int, n_pieces bigint, ids array<int>, log_prob double, gumbel double, log_inclusion double, round_trip boolean")
