"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A pre-token is a linked list of tokens, and every adjacent pair that has a rank waits in a queue. Two levels of bitmaps say where: one bit for each
word of WORD ranks, and below that the bits of a word's ranks, so that a find-first-set step on each gives the lowest rank at once. Of equal ranks the
leftmost comes first; an entry whose pair has changed is skipped. Each merge adds at most two entries.

Pre-tokens that are new in some texts share one queue (merge_all): what waits in a word is one array, with a lower bitmap for each pre-token, and a
step merges the lowest pair of every pre-token that has one in the lowest word. A pre-token that is merged alone (merge) has a heap for each rank, so one of
n bytes takes O(n log n) steps, however long it is.

Defined cases: a null text is an empty one and has no tokens; every byte has a token of its own, so any text has an encoding and
decoding gives its bytes back; repeated rows are encoded one by one; other columns are not read.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
from array import array
from collections import defaultdict
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from .arrow import slices

#: Parts held in each of a codec's caches, unless the caller says otherwise, and the longest part held; ranks in a word of the queue.
CACHED, CACHED_BYTES, WORD = 160_000, 64, 64
#: Characters of texts that are looked through for new parts at once (a longer text is looked through alone), and new parts whose pre-tokens share a
#: queue, with their characters.
LEARNED, MERGED, MERGED_CHARS = 1 << 22, 1 << 16, 1 << 18


class Recent(dict):
    """A dict of bounded size: when it is full it becomes the old half, and what is asked for again moves back."""

    def __init__(self, make, size: int):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        got = self.old.get(key)
        if got is None:
            got = self.make(key)
            if len(key) > CACHED_BYTES:
                return got
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = got
        return got

    def put(self, keys, values) -> None:
        if len(self) + len(keys) > self.size and self:
            self.old = dict(self)
            self.clear()
        self.update(zip(keys, values))

    def unknown(self, keys) -> list:
        """Those that are not held; those of the old half move back."""
        new = [x for x in keys if x not in self and len(x) < CACHED_BYTES]
        old = self.old
        if back := [x for x in new if x in old]:
            self.put(back, [old[x] for x in back])
            new = [x for x in new if x not in old]
        return new


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str, cached: int = CACHED):
        if pattern != CUTTABLE:
            raise ValueError("texts are taken apart at single spaces, which is known to be right for CUTTABLE only")
        self.ranks, self.size = ranks, max(ranks.values()) + 1
        self.bytes = {v: k for k, v in ranks.items()}
        self.said = {v: b" %d" % v for v in self.bytes}
        self.wide, self.long = np.zeros(self.size, np.int64), np.zeros(self.size, np.int64)  # bytes of a token as a number, and of the token
        for token, piece in self.bytes.items():
            self.wide[token], self.long[token] = len(self.said[token]), len(piece)
        self.find = regex.compile(pattern).findall
        self.filled = [0] * (self.size // WORD + 1)  # the lower bitmap of merge; empty between calls
        self.singles = np.array([ranks.get(bytes([a]), -1) for a in range(256)], np.int64)
        if self.singles.min() < 0:
            raise ValueError("every byte must have a token of its own")
        self.pairs = Pairs(ranks, self.size + 1)
        self.pieces = Recent(self.merge, cached * 3 // 2)
        self.heads, self.parts = Recent(self._say, cached), Recent(lambda part: self._say(" " + part), cached)
        self.arrays = Recent(lambda part: array("i", self.ids(part)).tobytes(), cached)

    @classmethod
    def load(cls, lines, pattern: str, cached: int = CACHED) -> Codec:
        return cls({base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}, pattern, cached)

    def merge(self, piece: bytes) -> list[int]:
        """Token ids of one pre-token."""
        get = self.ranks.get
        if (whole := get(piece)) is not None:
            return [whole]
        n = len(piece)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = [-1] * n  # the rank under which a position is queued now
        filled, words = self.filled, 0
        buckets: dict[int, list[int]] = {}
        for k in range(n - 1):
            rank = get(piece[k : k + 2])
            if rank is not None:
                pair[k] = rank
                if rank in buckets:
                    buckets[rank].append(k)
                else:
                    buckets[rank] = [k]
                    filled[rank // WORD] |= 1 << rank % WORD
                    words |= 1 << rank // WORD
        while words:
            word = (words & -words).bit_length() - 1
            bits = filled[word]
            rank = word * WORD + (bits & -bits).bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                k = heappop(bucket)
            else:
                k = bucket[0]
                del buckets[rank]
                filled[word] = bits = bits & (bits - 1)
                if not bits:
                    words &= words - 1
            if pair[k] != rank:
                continue  # stale
            gone = after[k]
            pair[gone] = pair[k] = -1
            after[k] = following = after[gone]
            if following < n:
                before[following] = k
                rank = get(piece[k : after[following]])
                if rank is not None:
                    pair[k] = rank
                    if rank in buckets:
                        heappush(buckets[rank], k)
                    else:
                        buckets[rank] = [k]
                        filled[rank // WORD] |= 1 << rank % WORD
                        words |= 1 << rank // WORD
            left = before[k]
            if left >= 0:
                rank = get(piece[left:following])
                if rank is None:
                    pair[left] = -1
                else:
                    pair[left] = rank
                    if rank in buckets:
                        heappush(buckets[rank], left)
                    else:
                        buckets[rank] = [left]
                        filled[rank // WORD] |= 1 << rank % WORD
                        words |= 1 << rank // WORD
        out, k, ranks = [], 0, self.ranks
        while k < n:
            out.append(ranks[piece[k : after[k]]])
            k = after[k]
        return out

    def merge_all(self, pieces: list[bytes]) -> list[list[int]]:
        """Token ids of each pre-token; none of them is a token itself."""
        tokens, sizes = self.merge_flat(b"".join(pieces), np.array([len(x) for x in pieces], np.int64))
        tokens, ends = tokens.tolist(), [0, *np.cumsum(sizes).tolist()]
        return [tokens[a:b] for a, b in pairwise(ends)]

    def merge_flat(self, text: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """text: pre-tokens joined, of these sizes in bytes; none is empty or a token itself. Returns their tokens, joined, and how many each has.
        One queue holds the pairs of all. Between pre-tokens stands a place with a token that makes no pair, so no merge reaches over it, and
        a step merges one pair at most in each, in the order of a queue of its own."""
        if not len(sizes):
            return np.empty(0, np.int64), sizes
        own = np.repeat(np.arange(len(sizes)), sizes + 1)  # which pre-token a place belongs to; the place after it included
        live = np.ones(len(own) + 1, bool)
        live[0] = False
        live[np.cumsum(sizes + 1)] = False
        own = np.concatenate([[-1], own])
        token = np.full(len(own), self.size, np.int64)
        token[live] = self.singles[np.frombuffer(text, np.uint8)]
        after, before = np.arange(1, len(own) + 1), np.arange(-1, len(own) - 1)
        pair = np.full(len(own), -1, np.int64)  # the rank under which a place is queued now
        pair[:-1] = self.pairs.ranks(token[:-1], token[1:])
        buckets: list[list[np.ndarray]] = [[] for _ in self.filled]
        words, one = 0, np.uint64(1)

        def queue(at: np.ndarray, rank: np.ndarray) -> int:
            """Returns the bits of the words where something waits now that has not before."""
            word = rank // WORD
            order = np.argsort(word, kind="stable")
            at, word = at[order], word[order]
            cuts = np.flatnonzero(word[1:] != word[:-1]) + 1
            bits, start = 0, 0
            for w, end in zip(word[np.concatenate([[0], cuts])].tolist(), [*cuts.tolist(), len(at)]):
                buckets[w].append(at[start:end])
                bits |= 1 << w
                start = end
            return bits

        first = np.flatnonzero(pair >= 0)
        if len(first):
            words = queue(first, pair[first])
        while words:
            word = (words & -words).bit_length() - 1
            words &= words - 1
            k = buckets[word][0] if len(buckets[word]) == 1 else np.concatenate(buckets[word])
            buckets[word] = []
            k = k[pair[k] // WORD == word]  # the others are stale
            if not len(k):
                continue
            k.sort()
            piece = own[k]
            new = np.empty(len(k), bool)
            new[0] = True
            np.not_equal(piece[1:], piece[:-1], out=new[1:])
            if not new.all():
                bits = one << (pair[k] % WORD).astype(np.uint64)
                heads = np.flatnonzero(new)
                low = np.bitwise_or.reduceat(bits, heads)  # the lower bitmap of each pre-token
                low &= ~low + one
                lowest = np.flatnonzero(bits == low[np.cumsum(new) - 1])
                piece = piece[lowest]
                new = np.empty(len(lowest), bool)
                new[0] = True
                np.not_equal(piece[1:], piece[:-1], out=new[1:])
                lowest = lowest[new]  # of equal ranks the leftmost
                wait = np.ones(len(k), bool)
                wait[lowest] = False
                buckets[word].append(k[wait])
                words |= 1 << word
                k = k[lowest]
            gone = after[k]
            live[gone] = False
            pair[gone] = -1
            token[k] = rank = pair[k]
            after[k] = following = after[gone]
            before[following] = k
            left = before[k]
            at = np.concatenate([k, left])
            found = self.pairs.ranks(np.concatenate([rank, token[left]]), np.concatenate([token[following], rank]))
            pair[at] = found
            some = found >= 0
            if some.any():
                words |= queue(at[some], found[some])
        return token[live], np.bincount(own[live], minlength=len(sizes))

    def learn(self, texts: list[str], cache: Recent, before: str = "") -> list[tuple[list[str], list[str]]]:
        """Merges together, MERGED parts at a time, the pre-tokens of those parts of the texts that are new, and puts the parts in the caches.
        cache: knows parts of earlier texts, with before in front. Returns how each text is taken apart: parts as they are, which self.heads
        knows (with before: cache), and the rest, which cache knows without their space (none with before). What is too long for the caches
        is merged when it is asked for, one by one."""
        cuts, known, heads, parts = [], cache if before else self.heads, set(), set()
        for text in texts:
            if _MIXED(text):
                cut = [*segments(text)], []
            else:  # a text can be taken apart at every space
                head, *rest = text.split(" ")
                cut = ([head, *[before + x for x in rest]], []) if before else ([head], rest)
            heads.update(cut[0])
            parts.update(cut[1])
            cuts.append(cut)
        for to, new, space in (known, known.unknown(heads), ""), (cache, [] if before else cache.unknown(parts), " "):
            start = size = 0
            for k, part in enumerate(new):
                size += len(part)
                if k + 1 == len(new) or k + 1 - start >= MERGED or size >= MERGED_CHARS:
                    some = new[start : k + 1]
                    to.put(some, (self._arrays if before else self._says)([space + x for x in some] if space else some))
                    start, size = k + 1, 0
        return cuts

    def ids_all(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of the parts, joined, and how many there are up to the beginning of each part and the end of the last."""
        number: defaultdict[str, int] = defaultdict()  # of each pre-token
        number.default_factory = number.__len__
        find, sizes, order = self.find, [], []
        for part in parts:
            own = find(part)
            sizes.append(len(own))
            order += map(number.__getitem__, own)
        pieces = list(number)
        get = self.ranks.get
        whole = np.array([get(piece.encode(), -1) for piece in pieces], np.int64)
        new = [piece for piece, token in zip(pieces, whole.tolist()) if token < 0]
        text = "".join(new).encode()
        places = np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)  # where characters begin
        ends = np.append(places, len(text))[np.cumsum([0, *map(len, new)])]
        merged, counts = self.merge_flat(text, np.diff(ends))
        count = np.ones(len(pieces), np.int64)
        count[whole < 0] = counts
        start = np.cumsum(count) - count
        flat = np.empty(int(count.sum()), np.int64)
        flat[start[whole >= 0]] = whole[whole >= 0]
        flat[np.repeat(whole < 0, count)] = merged
        at = np.array(order, np.int64)
        count = count[at]
        done = np.concatenate([[0], np.cumsum(count)])
        tokens = flat[np.repeat(start[at] - done[:-1], count) + np.arange(done[-1])]
        return tokens, done[np.cumsum([0, *sizes])]

    def _says(self, parts: list[str]) -> list[tuple[bytes, bytes]]:
        tokens, ends = self.ids_all(parts)
        every = tokens.tolist()
        said, decoded = b"".join(map(self.said.__getitem__, every)), self.decode(every)
        a, b = (np.concatenate([[0], np.cumsum(size[tokens])])[ends].tolist() for size in (self.wide, self.long))
        return [(said[i:j], decoded[k:m]) for i, j, k, m in zip(a, a[1:], b, b[1:])]

    def _arrays(self, parts: list[str]) -> list[bytes]:
        tokens, ends = self.ids_all(parts)
        every = tokens.astype(np.int32).tobytes()
        return [every[a:b] for a, b in pairwise((4 * ends).tolist())]

    def ids(self, text: str) -> list[int]:
        out: list[int] = []
        for match in self.find(text):
            out += self.pieces[match.encode()]
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def _say(self, part: str) -> tuple[bytes, bytes]:
        ids = self.ids(part)
        return b"".join(map(self.said.__getitem__, ids)), self.decode(ids)

    def encode(self, text: str) -> array:
        """All ids of a text, part by part as in digest."""
        return self.join(*self.learn([text], self.arrays, " ")[0])

    def join(self, parts: list[str], _: list[str]) -> array:
        return array("i", b"".join(map(self.arrays.__getitem__, parts)))

    def digest(self, text: str) -> tuple[int, bytes, bytes]:
        """How many ids, the ids as decimal numbers joined by spaces, and the bytes that they decode to.

        The text is taken apart where a single space stands between two characters that are not white space. No match
        of the pattern spans such a place (a match that reaches it ends, and the next one begins with the space),
        so the parts' results joined are the text's, and a part seen before costs one look-up."""
        return self.tell(*self.learn([text], self.parts)[0])

    def tell(self, heads: list[str], parts: list[str]) -> tuple[int, bytes, bytes]:
        got = [*map(self.heads.__getitem__, heads), *map(self.parts.__getitem__, parts)]
        said = b"".join([x[0] for x in got])[1:]
        return said.count(b" ") + 1 if said else 0, said, b"".join([x[1] for x in got])


class Pairs:
    """The ranks of pairs of tokens: a cuckoo table, where a pair stands in one of two places."""

    def __init__(self, ranks: dict[bytes, int], base: int):
        get, both = ranks.get, array("q")
        for piece, rank in ranks.items():
            for k in range(1, len(piece)):
                if (a := get(piece[:k])) is not None and (b := get(piece[k:])) is not None:
                    both.extend((a * base + b, rank))
        self.base = base
        keys, found = np.ascontiguousarray(np.array(both, np.int64).reshape(-1, 2).T)
        bits = max(4, (2 * len(keys)).bit_length() + 1)
        self.shift, rng, every = np.uint64(64 - bits), np.random.default_rng(1), np.arange(len(keys))
        owner, moved = np.empty(1 << bits, np.int64), None
        while moved is None or len(moved):  # with other factors, in the rare case that these leave someone without a place
            self.factors = rng.integers(1 << 63, size=2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            places, second = np.stack([self._place(keys, f) for f in self.factors]), np.zeros(len(keys), np.int64)
            owner.fill(-1)
            moved = every
            for _ in range(200):  # who comes to a place sends away who is there
                owner[places[second[moved], moved]] = moved
                moved = np.flatnonzero(owner[places[second, every]] != every)
                if not len(moved):
                    break
                second[moved] ^= 1
        self.keys, self.found = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int32)
        at = places[second, every]
        self.keys[at], self.found[at] = keys, found

    def _place(self, keys: np.ndarray, factor: np.uint64) -> np.ndarray:
        return ((keys.view(np.uint64) * factor) >> self.shift).view(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, or -1."""
        keys = left * self.base + right
        a, b = (self._place(keys, f) for f in self.factors)
        return np.where(self.keys[a] == keys, self.found[a], np.where(self.keys[b] == keys, self.found[b], -1))


def groups(texts: list[str]) -> Iterator[list[str]]:
    """Texts that are looked through at once."""
    some, size = [], 0
    for text in texts:
        if some and size + len(text) > LEARNED:
            yield some
            some, size = [], 0
        some.append(text)
        size += len(text)
    if some:
        yield some


#: The one pattern for which a match never goes on past a single space between two characters that are not white space.
CUTTABLE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A space beside other white space, or at either end.
_MIXED = re.compile(r" (?:(?<=\s\s)|(?<=\A )|(?=\s|\Z))").search


def segments(text: str) -> Iterator[str]:
    """Parts that begin with the space before which the text was cut."""
    pieces = text.split(" ")
    held, clean = pieces[0], bool(pieces[0]) and not pieces[0][-1].isspace()
    for piece in pieces[1:]:
        if clean and piece and not piece[0].isspace():
            yield held
            held = " " + piece
        else:
            held += " " + piece
        clean = bool(piece) and not piece[-1].isspace()
    yield held


_codecs: dict[tuple[str, str, int], Codec] = {}


def codec(name: str, pattern: str, cached: int) -> Codec:
    """The worker's codec of a rank file that the driver has sent with SparkContext.addFile."""
    if (name, pattern, cached) not in _codecs:
        with open(SparkFiles.get(name), "rb") as f:
            _codecs[name, pattern, cached] = Codec.load(f, pattern, cached)
    return _codecs[name, pattern, cached]


def forget() -> None:
    """Workers outlive their query: another operator's tasks can let go here of what encoding has left in theirs. A codec's caches refer to it, so
    it goes only when such cycles are looked for; and what it has taken is given back to the system."""
    if _codecs:
        _codecs.clear()
        gc.collect()
        for pool in pa.default_memory_pool(), pa.system_memory_pool():
            pool.release_unused()


def _send(docs: DataFrame, path: str) -> str:
    docs.sparkSession.sparkContext.addFile(path)
    return path.rpartition("/")[2]


def encode(docs: DataFrame, path: str, pattern: str, cached: int = CACHED) -> DataFrame:
    """docs: doc_id, text. Returns doc_id, n_tokens, ids_sha256, decoded_sha256. cached: parts held in each of a worker's caches."""
    name = _send(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(name, pattern, cached)
        for batch in slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            rows = [own.tell(*cut) for some in groups(texts) for cut in own.learn(some, own.parts)]
            sha = lambda k: pa.array([hashlib.sha256(r[k]).hexdigest() for r in rows], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([r[0] for r in rows], pa.int64()), sha(1), sha(2)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def tokens(docs: DataFrame, path: str, pattern: str, cached: int = CACHED) -> DataFrame:
    """docs: text and any columns but n_tokens, ids and decoded_sha256, which would be there twice (ValueError). In place of text:
    n_tokens, ids (of the whole text) and decoded_sha256 (of the bytes to which the ids decode)."""
    if clash := {"n_tokens", "ids", "decoded_sha256"} & set(docs.columns):
        raise ValueError(f"docs has columns of this operator's: {sorted(clash)}")
    name = _send(docs, path)
    rest = [f for f in docs.schema if f.name != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(name, pattern, cached)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [t or "" for t in part.column("text").to_pylist()]
                got = [own.join(*cut) for some in groups(texts) for cut in own.learn(some, own.arrays, " ")]
                n = np.array([len(g) for g in got], np.int32)
                flat = np.concatenate([np.frombuffer(g, np.int32) for g in got if len(g)] or [np.empty(0, np.int32)])
                ids = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(n)]).astype(np.int32), pa.array(flat))
                sha = pa.array([hashlib.sha256(own.decode(g)).hexdigest() for g in got], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(f.name) for f in rest), pa.array(n.astype(np.int64)), ids, sha], [*(f.name for f in rest), "n_tokens", "ids", "decoded_sha256"]
                )

    return docs.mapInArrow(run, f"{schema}, n_tokens long, ids array<int>, decoded_sha256 string")
