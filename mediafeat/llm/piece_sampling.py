"""SentencePiece encoding by Gumbel top-k sampling over the lattice, and decoding.

A text (blanks as U+2581, one put in front) spans a lattice whose edges are the
vocabulary's pieces; characters without a piece become their bytes.  The lattice
falls apart at word starts, so a distinct word's part is solved once for many texts of a
task: forward sums give each node's distribution over the edges that end there.

A segmentation is a sequence of such choices.  Perturbed A-star search draws ``k`` of
them without replacement: the root's Gumbel value belongs to one sampled
segmentation; each of its choices opens a subtree of segmentations that differ
there first, whose best Gumbel value is drawn conditionally on the parent's; the
subtree with the highest value is realised next.  The (k+1)-th value is the threshold
of the inclusion scores 1 - exp(-exp(log p - threshold)).  Random numbers are hashes
of the row's key and of the choice's place, so a row's samples do not depend on the
batch it is in.

A model of merges has ranks instead of log probabilities; a piece's log weight is
then ``-alpha * log(rank + 2)``.

Nulls: a null text counts as empty; it has one segmentation, with no pieces.  A text
with fewer than ``k`` segmentations gives all of them, each with inclusion 1.
Decoding any sample gives the text back, also where it holds U+2581 itself.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediafeat.llm import kernels as K
from mediafeat.llm.common import text_of

U = np.uint64
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK, LITERAL = 0x2581, 0x110000     # a blank; U+2581 in the text itself
SAMPLES = 2
ALPHA = 0.5
RUN = 1 << 18         # characters handled at a time
ROOM = 8 << 20        # edges of solved words kept for the next texts (15 bytes each with their nodes)
WORD_BITS = 20        # of a word's hash: its slot
NEAR, HIGHEST = 256, 40.0       # choices looked at first; above the largest Gumbel value of a 53-bit random number
SLOT_BITS, SEEN_BITS = 21, 18     # of a piece's hash: its slot, and a small table of hashes in use
SCHEMA = ("doc_id long, sample int, n_chars long, n_pieces long, ids array<int>, ids_sha256 string, log_prob double, perturbed double, "
          "inclusion double, round_trip boolean")


class Vocabulary:
    """Pieces of a model as arrays; plain data, so that it can be broadcast."""

    def __init__(self, path: str = MODEL, alpha: float = ALPHA) -> None:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces, self.ids, weight, self.byte_ids = [], [], [], np.zeros(256, np.int32)
        scores = [sp.get_score(i) for i in range(n)]
        ranks = all(float(s).is_integer() for s in scores)
        for i in range(n):
            if sp.is_byte(i):
                self.byte_ids[int(sp.id_to_piece(i)[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.pieces.append(sp.id_to_piece(i))
                self.ids.append(i)
                rank = min(max(-scores[i], 0.0), float(n))
                weight.append(-alpha * np.log(rank + 2.0) if ranks else alpha * scores[i])
        self.ids = np.array(self.ids, np.int32)
        self.weight = np.array(weight)
        self.fallback = float(self.weight.min()) - 10.0
        self.width = max(map(len, self.pieces))
        inner = [p for p in self.pieces if chr(BLANK) in p.lstrip(chr(BLANK))]
        self.splits = not inner                      # no piece runs over a word start
        self.surface = [p.replace(chr(BLANK), " ").encode() for p in self.pieces]

    @functools.cached_property
    def tables(self):
        """(hash prefixes in use, slots, next in slot, hashes) of the pieces."""
        cps = np.frombuffer("".join(self.pieces).encode("utf-32-le"), np.uint32)
        end = np.cumsum([len(p) for p in self.pieces])
        h = _spans(K.range_sums(_codes(cps)), end - [len(p) for p in self.pieces], end)
        slots, after = np.full(1 << SLOT_BITS, -1, np.int32), np.full(len(h), -1, np.int32)
        seen = np.zeros(1 << SEEN_BITS, bool)
        seen[(h >> U(64 - SEEN_BITS)).astype(np.int64)] = True
        for i, s in enumerate((h >> U(64 - SLOT_BITS)).tolist()):
            after[i], slots[s] = slots[s], i
        return seen, slots, after, h

    @functools.cached_property
    def lengths(self):
        """(by the hash of a pair of characters: the lengths, as bits, of the pieces
        that start with the pair, and of those that end with it)."""
        first, last = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.uint32)
        for p in self.pieces:
            if len(p) > 1:
                a, z = (_pair(np.array([ord(x[0])], np.uint32), np.array([ord(x[1])], np.uint32))[0] for x in (p[:2], p[-2:]))
                first[a] |= np.uint32(1 << (len(p) - 1))
                last[z] |= np.uint32(1 << (len(p) - 1))
        return first, last

    def find(self, h: np.ndarray) -> np.ndarray:
        """The piece of each hash, or -1."""
        seen, slots, after, own = self.tables
        out = np.full(len(h), -1, np.int32)
        left = np.flatnonzero(seen[(h >> U(64 - SEEN_BITS)).view(np.int64)])
        _chained(h, left, slots[(h[left] >> U(64 - SLOT_BITS)).view(np.int64)], after, own, out)
        return out

    @functools.cached_property
    def spelled(self):
        """Bytes of the tokens by id, for decoding."""
        import pyarrow as pa
        n = int(max(self.ids.max(), self.byte_ids.max())) + 1
        by = [b""] * n
        for i, s in zip(self.ids.tolist(), self.surface):
            by[i] = s
        for b, i in enumerate(self.byte_ids.tolist()):
            by[i] = bytes([b])
        return pa.array(by, pa.large_binary())

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 text of token ids."""
        import pyarrow as pa
        if not len(ids):
            return b""
        spelled = self.spelled.take(pa.array(ids))
        _, bounds, raw = spelled.buffers()
        end = int(np.frombuffer(bounds, np.int64)[len(ids)])
        return raw.slice(1, end - 1).to_pybytes()       # without the blank put in front


def _codes(cps: np.ndarray) -> np.ndarray:
    return K.mix(cps.astype(U) + U(0x1F123BB5))


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a * np.uint32(0x9E3779B1) ^ b) * np.uint32(0x85EBCA77) >> np.uint32(16)).astype(np.int64)


def _spans(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of character ranges, from their prefix sums."""
    _, down = K.powers(len(sums))
    h = (sums[end] - sums[start]) * down[start]
    h ^= h >> U(32)
    return h * U(K.COEF[0] | 1)


def _unit(x: np.ndarray) -> np.ndarray:
    """In (0, 1), from 64 bits."""
    return ((K.mix(x) >> U(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def _uniform(key: np.ndarray, *parts) -> np.ndarray:
    """In (0, 1), from a key and small counters."""
    x = key.copy()
    for p, c in zip(parts, K.COEF):
        x += np.asarray(p).astype(U) * U(c)
    return _unit(x)


def _ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start, start + 1, ...: ``count`` numbers of each."""
    end = np.cumsum(count)
    out = np.repeat(start - (end - count), count)
    out += np.arange(len(out))
    return out


def _chained(h: np.ndarray, left: np.ndarray, at: np.ndarray, after: np.ndarray, own: np.ndarray, out: np.ndarray) -> None:
    """Put the entry with hash ``h[left]`` into ``out[left]``: the chain starts at ``at``."""
    while True:
        on = np.flatnonzero(at >= 0)
        left, at = left[on], at[on]
        if not len(left):
            return
        hit = own[at] == h[left]
        out[left[hit]] = at[hit]
        on = np.flatnonzero(~hit)
        left, at = left[on], after[at[on]]


def _put(held: np.ndarray, n: int, more: np.ndarray) -> np.ndarray:
    """``more`` after the first ``n`` items, in an array with room to grow."""
    if n + len(more) > len(held):
        held = np.concatenate([held[:n], np.empty(max(n, len(more)) + n // 4, held.dtype)])
    held[n:n + len(more)] = more
    return held


class Words:
    """The solved words of a task's texts: each node's edges with their probabilities.

    A word has a node before each character and one at its end; an edge is a piece
    that ends at its node, longest first.  Words are known by 64-bit hashes.  Above
    ``room`` edges only the words met again stay (none, if they are too many)."""

    def __init__(self, vocab: Vocabulary, room: int = ROOM) -> None:
        self.v, self.room = vocab, room
        self.weight = np.append(vocab.weight, vocab.fallback)            # by piece; the last is a character without one
        self.length = np.append([len(p) for p in vocab.pieces], 1).astype(np.int8)
        self.hash, self.after, self.again = np.zeros(0, U), np.zeros(0, np.int32), np.zeros(0, bool)
        self.base, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)    # of a word: its first node, its characters
        self.prob = np.zeros(0)
        self._clear()

    def _clear(self) -> None:
        most = self.room + self.room // 4
        if len(self.prob) != most:        # at first, or grown for a very long text
            self.ptr = np.empty(most // 2 + 1, np.int64)                       # of a node: its first edge
            self.prob, self.piece = np.empty(most), np.empty(most, np.int32)
        self.n = self.nodes = self.edges = self.ptr[0] = 0
        self.slots = np.full(1 << WORD_BITS, -1, np.int32)

    def numbers(self, cp: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The number of each word of a text; the new ones are solved."""
        if self.edges > self.room:
            self._shrink()
        h = K.range_hash(K.range_sums(_codes(cp)), start, start + size)
        out = np.full(len(h), -1, np.int32)
        _chained(h, np.arange(len(h)), self.slots[(h >> U(64 - WORD_BITS)).view(np.int64)], self.after, self.hash, out)
        known = out >= 0
        self.again[out[known]] = True
        new = np.flatnonzero(~known)
        if len(new):
            own, where, which = np.unique(h[new], return_index=True, return_inverse=True)
            at = new[where]
            out[new] = self.n + which
            self._add(own, size[at], *self._solve(cp, start[at], size[at]))
        return out

    def _add(self, own: np.ndarray, size: np.ndarray, count: np.ndarray, piece: np.ndarray, prob: np.ndarray, again: bool = False) -> None:
        """``own``: ascending hashes; ``count``: each node's edges."""
        n, nodes, edges = self.n, self.nodes, self.edges
        number = np.arange(n, n + len(own), dtype=np.int32)
        slot = (own >> U(64 - WORD_BITS)).view(np.int64)
        same = slot[1:] == slot[:-1]
        before = self.slots[slot]
        before[1:][same] = number[:-1][same]
        last = np.append(~same, True)
        self.slots[slot[last]] = number[last]
        self.hash, self.after = _put(self.hash, n, own), _put(self.after, n, before)
        self.again = _put(self.again, n, np.full(len(own), again))
        self.base, self.size = _put(self.base, n, nodes + np.cumsum(size + 1) - (size + 1)), _put(self.size, n, size)
        self.ptr = _put(self.ptr, nodes + 1, edges + np.cumsum(count))
        self.piece, self.prob = _put(self.piece, edges, piece), _put(self.prob, edges, prob)
        self.n, self.nodes, self.edges = n + len(own), nodes + len(count), edges + len(piece)

    def _shrink(self) -> None:
        keep = np.flatnonzero(self.again[:self.n])
        keep = keep[np.argsort(self.hash[keep])]
        node, size = self.base[keep], self.size[keep]
        edge, m = self.ptr[node], self.ptr[node + size + 1] - self.ptr[node]
        if not 0 < 2 * int(m.sum()) <= self.room:
            return self._clear()
        nodes, edges = _ranges(node, size + 1), _ranges(edge, m)
        held = self.hash[keep], size, self.ptr[nodes + 1] - self.ptr[nodes], self.piece[edges], self.prob[edges]
        self._clear()
        self._add(*held)

    def _solve(self, cp: np.ndarray, start: np.ndarray, size: np.ndarray):
        """(edges of each node, their pieces, their probabilities) of words."""
        w, deep = self.v.width, int(size.max())
        chars = np.cumsum(size) - size
        flat = cp[_ranges(start, size)]
        sums = K.range_sums(_codes(flat))
        j = (np.arange(len(flat)) - np.repeat(chars, size) + 1).astype(np.int32)     # the node of its word a character ends at
        hits = np.full((len(flat), w), -2, np.int32)              # by character and length: the piece that ends there
        starts, finishes = self.v.lengths
        pair = _pair(flat[:-1], flat[1:])                         # characters i and i + 1
        begin, end = np.zeros(len(flat), np.uint32), np.zeros(len(flat), np.uint32)
        begin[:-1], end[1:] = starts[pair], finishes[pair]
        for n in range(min(w, deep), 1, -1):    # only spans whose first and last pairs are those of some piece of the length
            on = np.flatnonzero(((begin[:len(flat) - n + 1] & end[n - 1:]) & np.uint32(1 << (n - 1))) != 0) + (n - 1)
            on = on[j[on] >= n]
            hit = self.v.find(_spans(sums, on + (1 - n), on + 1))
            ok = hit >= 0
            hits[on[ok], w - n] = hit[ok]                         # long pieces first: they are the likelier
        p = np.arange(len(flat))
        hits[:, w - 1] = self.v.find(_spans(sums, p, p + 1))      # characters without a piece: bytes
        used = np.flatnonzero(hits.reshape(-1) != -2)
        piece = hits.reshape(-1)[used]
        del hits
        base = chars + np.arange(len(size))                       # a word's first node
        count = np.zeros(len(flat) + len(size), np.int64)
        ends = np.ones(len(count), bool)
        ends[base] = False
        count[ends] = np.bincount(used // w, minlength=len(flat))
        ptr = np.cumsum(count) - count
        order = base[np.argsort(-size, kind="stable")]            # longest words first
        alive = len(size) - np.searchsorted(np.sort(size), np.arange(deep + 1))    # words with a node on each level
        total, prob = np.zeros(len(count)), np.empty(len(piece))
        for x in range(1, deep + 1):
            nodes = order[:alive[x]] + x
            n = count[nodes]
            rows = np.cumsum(n) - n
            at = _ranges(ptr[nodes], n)
            of = piece[at]
            e = total[np.repeat(nodes, n) - self.length[of]] + self.weight[of]
            top = np.maximum.reduceat(e, rows)
            e = np.exp(e - np.repeat(top, n))
            s = np.add.reduceat(e, rows)
            total[nodes] = top + np.log(s)
            prob[at] = e / np.repeat(s, n)
        return count, piece, prob


class Lattice:
    """The word lattices of a batch of texts and its A-star search."""

    def __init__(self, words: Words, texts: list[str], keys: np.ndarray) -> None:
        """``texts``: none empty; ``keys``: a 64-bit key per text."""
        self.v, self.keys, self.n = words.v, keys, len(texts)
        lens = np.array([len(t) + 1 for t in texts], np.int64)
        end = np.cumsum(lens)
        cp = np.frombuffer((" " + " ".join(texts)).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
        cp[cp == BLANK] = LITERAL
        cp[cp == 32] = BLANK
        cp[end - lens] = BLANK
        blank = cp == BLANK
        first = np.zeros(len(cp), bool)
        if self.v.splits:
            first[1:] = blank[1:] & ~blank[:-1]
        first[end - lens] = True
        self.cp, self.start = cp, np.flatnonzero(first)
        size = np.diff(np.append(self.start, len(cp)))
        self.first_word = np.searchsorted(self.start, end - lens)
        self.end_word = np.append(self.first_word[1:], len(self.start))
        self.doc = np.repeat(np.arange(self.n), self.end_word - self.first_word)
        kind = words.numbers(cp, self.start, size)
        self.base = words.base[kind]
        self.last = self.base + size                              # each word's end node
        self.nodes, self.ptr, self.prob, self.piece, self.length = words.nodes, words.ptr, words.prob, words.piece, words.length
        self.word_keys = keys[self.doc] + (np.arange(len(self.doc)) - self.first_word[self.doc]).astype(U) * U(K.COEF[0])

    def _walk(self, words: np.ndarray, at: np.ndarray, step, salt: int):
        """Free choices from node ``at`` of each word down to its start: (word, step, edge)."""
        out = []
        key = self.word_keys[words] + (np.zeros(1, U) + U(salt)) * U(K.COEF[2])
        key += (np.zeros(1, U) + np.asarray(step).astype(U)) * U(K.COEF[1])
        while True:
            edge, stop = self.ptr[at], self.ptr[at + 1]
            on = np.flatnonzero(edge < stop)                      # a start has no edges
            if len(on) < len(words):
                words, at, key, edge, stop = words[on], at[on], key[on], edge[on], stop[on]
                step = step[on] if isinstance(step, np.ndarray) else step
            if not len(words):
                return out
            goal, stop = _unit(key), stop - 1
            run = self.prob[edge]                                 # a node's probabilities sum to 1
            left = np.flatnonzero((run < goal) & (edge < stop))
            e, run, aim, stop = edge[left], run[left], goal[left], stop[left]
            while len(left):
                e += 1
                run += self.prob[e]
                edge[left] = e
                go = np.flatnonzero((run < aim) & (e < stop))
                left, e, run, aim, stop = left[go], e[go], run[go], aim[go], stop[go]
            out.append((words, step, edge))
            at, step = at - self.length[self.piece[edge]], step + 1
            key = key + U(K.COEF[1])

    def _path(self, parts):
        """Choices put in order, by word, then by step (in which order they come):
        (bounds of each word's choices, edges)."""
        count = np.bincount(np.concatenate([word for word, _, _ in parts]), minlength=len(self.start))
        bounds = np.concatenate([[0], np.cumsum(count)])
        out = np.empty(bounds[-1], np.int64)
        for word, step, edge in parts:
            out[bounds[word] + step] = edge
        return bounds, out

    def _node(self, edge: np.ndarray) -> np.ndarray:
        """The node where an edge ends."""
        return np.searchsorted(self.ptr[:self.nodes + 1], edge, "right") - 1

    def _row(self, node: np.ndarray):
        """(edge numbers, probabilities) of nodes, one row each; 0 where there is none."""
        i = self.ptr[node][:, None] + np.arange(self.v.width)
        ok = i < self.ptr[node + 1][:, None]
        return i, np.where(ok, self.prob[np.minimum(i, len(self.prob) - 1)], 0.0)

    def sample(self, k: int):
        """Per rank: (texts, path, log probability, perturbed value); and each text's threshold."""
        words = np.arange(len(self.start))
        path = self._path(self._walk(words, self.last, 0, 0))
        value = -np.log(-np.log(_uniform(self.keys, 1, 0, 1 << 40)))
        docs = np.arange(self.n)
        from_choice = np.zeros(self.n, np.int64)      # of each text's part of the path: where it left its parent
        mask = np.zeros(self.n, np.int64)             # choices already taken there
        pool = []                                     # open subtrees: (doc, value, path, choice, mask)
        out = []
        threshold = np.full(self.n, -np.inf)
        for rank in range(k):
            bounds, edge = path
            begin = bounds[self.first_word[docs]]
            count = bounds[self.end_word[docs]] - begin
            logq = np.log(np.maximum(self.prob[edge], 1e-300))
            run = np.cumsum(logq)
            zero = run[begin] - logq[begin]
            out.append((docs, path, run[begin + count - 1] - run[begin] + logq[begin], value))
            # a subtree per choice from the place where the path left its parent
            # (the choices before it belong to the parent's other subtrees)
            begin, count = begin + from_choice, count - from_choice
            todo = np.arange(len(docs))
            for most in (NEAR, int(count.max())):
                first, n = begin[todo], np.minimum(count[todo], most)
                at = _ranges(first, n)
                before = run[at] - logq[at] - np.repeat(zero[todo], n)
                of, v, choice, taken = self._subtrees(docs[todo], value[todo], edge[at], before, n, from_choice[todo], mask[todo], rank, k - rank)
                # a choice's value is above its ``before`` by less than HIGHEST: those left out are lower
                low = np.full(len(todo), np.inf)
                np.minimum.at(low, of, v)
                low[np.bincount(of, minlength=len(todo)) < k - rank] = -np.inf
                end = first + n - 1
                more = (n < count[todo]) & (low <= run[end] - zero[todo] + HIGHEST)
                done = ~more[of]
                pool.append((docs[todo[of[done]]], v[done], np.full(int(done.sum()), rank), choice[done], taken[done]))
                todo = todo[more]
                if not len(todo):
                    break
            if not sum(len(c[0]) for c in pool):
                break
            # the best open subtree of each text
            p = [np.concatenate(c) for c in zip(*pool)]
            order = np.lexsort((-p[1], p[0]))
            p = [c[order] for c in p]
            lead = np.concatenate([[True], p[0][1:] != p[0][:-1]])
            if rank == k - 1:
                threshold[p[0][lead]] = p[1][lead]
                break
            pool = [tuple(c[~lead] for c in p)]
            docs, value, source, from_choice, mask = (c[lead] for c in p)
            path = self._branch(out, docs, source, from_choice, mask, rank + 1)
        return out, threshold

    def _subtrees(self, docs, value, edge, before, count, from_choice, mask, rank: int, most: int):
        """The ``most`` highest subtrees that leave each text's path at its ``count`` next
        choices: (place in ``docs``, value, choice, mask)."""
        begin = np.cumsum(count) - count
        chosen = self.prob[edge]
        place = np.arange(len(edge)) - np.repeat(begin - from_choice, count)
        rest = 1.0 - chosen
        if mask.any():
            free = (mask[:, None] >> np.arange(self.v.width)) & 1 == 0
            rest[begin] = (self._row(self._node(edge[begin]))[1] * free).sum(1) - chosen[begin]
        with np.errstate(divide="ignore", over="ignore", invalid="ignore"):
            phi = before + np.log(np.maximum(rest, 0.0))
            phi[rest < 1e-13] = -np.inf
            u = _uniform(np.repeat(self.keys[docs], count), place, rank, 1 << 41)
            v = phi - np.log(np.exp(phi - np.repeat(value, count)) - np.log(u))
        v[np.isneginf(phi) | np.isnan(v)] = -np.inf
        out = []
        for _ in range(most):
            at = np.flatnonzero(v == np.repeat(np.maximum.reduceat(v, begin), count))
            at = at[~np.isneginf(v[at])]
            of = np.searchsorted(begin, at, "right") - 1
            one = np.flatnonzero(np.diff(of, prepend=-1))
            at, of = at[one], of[one]
            taken = np.where(at == begin[of], mask[of], 0) | np.int64(1) << (edge[at] - self.ptr[self._node(edge[at])])
            out.append((of, v[at], place[at], taken))
            v[at] = -np.inf
        return [np.concatenate(c) for c in zip(*out)]

    def _branch(self, done, docs, source, choice, mask, salt):
        """The segmentations of the chosen subtrees."""
        parts, forced = [], [[], [], []]      # word, step, edge
        for s in np.unique(source).tolist():
            bounds, path = done[s][1]
            mine = source == s
            begin = bounds[self.first_word[docs[mine]]]
            cut = begin + choice[mine]
            for f, i in ((parts, _ranges(begin, cut - begin)), (forced, cut)):
                word = np.searchsorted(bounds, i, "right") - 1
                found = word, i - bounds[word], path[i]
                if f is parts:
                    f.append(found)
                else:
                    for x, y in zip(f, found):
                        x.append(y)
        word, step, edge = (np.concatenate(f) for f in forced)
        m = np.concatenate([mask[source == s] for s in np.unique(source).tolist()])
        node = self._node(edge)
        edges, free = self._row(node)
        free = free * ((m[:, None] >> np.arange(self.v.width)) & 1 == 0)
        c = np.cumsum(free, axis=1)
        d = self.doc[word]
        u = _uniform(self.keys[d], word - self.first_word[d], step, salt + (1 << 42))
        n = np.minimum((c <= (u * c[:, -1])[:, None]).sum(1), self.v.width - 1)
        bad = free[np.arange(len(n)), n] <= 0
        n[bad] = free[bad].argmax(1)
        edge = edges[np.arange(len(n)), n]
        parts.append((word, step, edge))
        parts += self._walk(word, node - self.length[self.piece[edge]], step + 1, salt)
        rest = _ranges(word + 1, self.end_word[d] - word - 1)      # the words after it are free
        parts += self._walk(rest, self.last[rest], 0, salt)
        return self._path(parts)

    def tokens(self, docs, path) -> tuple[np.ndarray, np.ndarray]:
        """(token ids in text order, bounds of each of the texts' tokens)."""
        bounds, edge = path
        # choices run from a word's end to its start: turn each word round
        edge = edge[np.repeat(bounds[:-1] + bounds[1:] - 1, np.diff(bounds)) - np.arange(len(edge))]
        piece = self.piece[edge]
        lone = np.flatnonzero(piece < 0)
        ids = self.v.ids[piece]
        at = np.append(bounds[self.first_word[docs]], len(ids))
        if len(lone):                                 # bytes of characters without a piece
            word = np.searchsorted(bounds, lone, "right") - 1
            c = self.cp[self.start[word] + self._node(edge[lone]) - self.base[word] - 1]
            c, which = np.unique(c, return_inverse=True)
            spelled = [chr(x if x != LITERAL else BLANK).encode("utf-8", "surrogatepass") for x in c.tolist()]
            size = np.array([len(s) for s in spelled], np.int64)
            begin, size = (np.cumsum(size) - size)[which], size[which]
            n = np.ones(len(ids), np.int64)
            n[lone] = size
            more = np.concatenate([[0], np.cumsum(size - 1)])
            out = np.repeat(ids, n)
            out[_ranges(lone + more[:-1], size)] = self.v.byte_ids[np.frombuffer(b"".join(spelled), np.uint8)[_ranges(begin, size)]]
            ids, at = out, at + more[np.searchsorted(lone, at)]
        return ids, at


def _runs(texts: list[str]):
    i, held = 0, 0
    for j, t in enumerate(texts):
        if held and held + len(t) > RUN:
            yield i, j
            i, held = j, 0
        held += len(t)
    if i < len(texts):
        yield i, len(texts)


def samples(vocab: Vocabulary, texts: list[str], keys: np.ndarray, k: int, words: Words | None = None):
    """(row, sample, ids, log_prob, perturbed, inclusion) of non-empty and empty texts;
    ``words``: those solved before."""
    words = words or Words(vocab)
    for i, j in _runs(texts):
        full = [x for x in range(i, j) if texts[x]]
        for x in range(i, j):
            if not texts[x]:
                yield x, 1, np.zeros(0, np.int32), 0.0, float(-np.log(-np.log(_uniform(keys[x:x + 1], 1, 0, 1 << 40)))[0]), 1.0
        if not full:
            continue
        lattice = Lattice(words, [texts[x] for x in full], keys[full])
        drawn, threshold = lattice.sample(k)
        for rank, (docs, path, logp, value) in enumerate(drawn):
            ids, at = lattice.tokens(docs, path)
            with np.errstate(over="ignore"):
                inclusion = np.where(np.isneginf(threshold[docs]), 1.0, -np.expm1(-np.exp(np.minimum(logp - threshold[docs], 700.0))))
            at = at.tolist()
            for d, a, z, p, g, q in zip(docs.tolist(), at, at[1:], logp.tolist(), value.tolist(), inclusion.tolist()):
                yield full[d], rank + 1, ids[a:z], p, g, q


def encode(docs: DataFrame, k: int = SAMPLES, model: str = MODEL, alpha: float = ALPHA) -> DataFrame:
    """Rows (document, sample): ids of ``k`` distinct sampled segmentations of every
    whole text with their scores, best perturbed value first; ``round_trip`` tells
    whether decoding gives the text back."""
    vocab = Vocabulary(model, alpha)
    vocab.tables, vocab.lengths, vocab.spelled      # made once, here
    shared = docs.sparkSession.sparkContext.broadcast(vocab)     # the model's pieces

    def run(batches):
        import pyarrow as pa
        vocab = shared.value
        words = Words(vocab)
        names = [f.split(" ")[0] for f in SCHEMA.split(", ")]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.string(), *[pa.float64()] * 3, pa.bool_()]
        for b in batches:
            doc, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            keys = K.mix(b.column(2).to_numpy(zero_copy_only=False).view(U).copy())
            rows, held = [], 0
            for x, rank, ids, p, g, q in samples(vocab, texts, keys, k, words):
                raw = ids.astype("<i4").tobytes()
                back = vocab.decode(ids)
                rows.append((doc[x], rank, len(texts[x]), len(ids), ids, hashlib.sha256(raw).hexdigest(), p, g, q,
                             back == texts[x].encode("utf-8", "surrogatepass")))
                held += len(ids)
                if held > 1 << 21:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], names)
    base = text_of(docs).select("doc_id", "text", F.xxhash64(F.lit(23), "doc_id").alias("key"))
    return base.mapInArrow(K.lean(run), SCHEMA)


def decode(rows: DataFrame, ids: str = "ids", model: str = MODEL) -> DataFrame:
    """``rows`` with the text that ``ids`` spell, as ``decoded``."""
    shared = rows.sparkSession.sparkContext.broadcast(Vocabulary(model))

    @F.pandas_udf("string")
    def spell(column):
        import pandas as pd
        return pd.Series([shared.value.decode(np.asarray(x, np.int64)).decode("utf-8", "replace") if x is not None and len(x) else "" for x in column])
    return rows.withColumn("decoded", spell(ids))
