"""LM scoring with a hashed maximum-entropy model.

A token's probability is that of its group given what stands before it, times that of its class within the group given the same, times
its share of the class: GROUPS x BINS classes, each step a softmax over GROUPS or BINS hashed features' weights. The context's features
are hashed into ROWS rows: the word before (an n-gram feature), the word before that (a skip feature), and the groups of
the three words before.

The classes come from the corpus. Words that stand beside the same very frequent words share a group (k-means of the OWN most frequent
words by their neighbours); within a group its words are dealt to bins by frequency; less frequent words go by their last two bytes to the
group whose neighbours those endings have, with one bin for words of the table and one for all others. In the last one
a word that training does not hold has the share that leaving one out gives it (words seen once against the rest), so that the
probabilities of all known tokens and of one unknown token a group add up to one.

Training is synchronous: in each of ROUNDS steps the tasks add up, over one slice of the training documents (by a hash
of doc_id; together the slices are all of them), how often each feature meets each class and how often the current weights expect
it to. The sums' gradient moves each weight by a step of the iterative-scaling kind, the logarithm of the two sums' ratio. As only
sums of tasks are used, the model does not depend on partitions (but for the rounding of sums).
Counts of tokens are exact, over all training documents, and stay distributed: a bounded table of frequent tokens goes to every
task, and all other tokens are joined with the counts, after they are added up for each document.

Tokens are known by 56 bits of XXH3 and 8 of their ending. Defined cases: a null text is an empty one and has the end token
alone; a null doc_id counts as the empty string and is held out; repeated rows are learned and scored one by one; the context goes on
through a text however long; without training documents the counts are zero; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrow import slices
from .common import cut, partitions, release
from .textnum import numbered, scramble

GROUPS, BINS, ENDINGS, NEIGHBOURS = 16, 16, 256, 64
CLASSES = GROUPS * BINS
OWN, FREQUENT = 1 << 14, 1 << 18
#: Rows of the three kinds of features (powers of two); ROWS in all.
PART = (1 << 12, 1 << 11, 1 << 11)
ROWS = sum(PART)
ROUNDS, RATE, DOUBT, STEP, BLOCKS, SAFE = 3, 0.4, 1.0, 8192, 64, 60
SEED, CHUNK, PIECE = 0x6C6D, 1 << 20, 1 << 24
#: A token's code is its rank in the table of frequent ones, or RARE and its ending. END is the hash of the end, BEGIN the code before a text.
RARE, END, BEGIN = 1 << 20, 1 << 63, 1 << 21


def is_held_out(doc_id):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def token(word: bytes) -> int:
    """The top bit, 55 bits of the word's hash and 8 of its ending's."""
    h = xxhash.xxh3_64_intdigest(word, SEED)
    return 1 << 63 | h & ~0xFF & (1 << 63) - 1 | xxhash.xxh3_64_intdigest(word[-2:], SEED) & 0xFF


@cache
def _endings() -> np.ndarray:
    """The lowest byte of the tokens that end with each two bytes, then of those of one byte."""
    every = [bytes([x]) for x in range(256)]
    return np.array([token(w) & 0xFF for w in chain((x + y for x in every for y in every), every)], np.uint64)


def different(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The parts' different words by token(), which of them each word is, and how many words each part has. Only different words are
    Python objects."""
    lowered = pc.ascii_lower(pa.array(parts, pa.large_binary()).view(pa.large_string()))
    which, sizes, kinds = numbered(lowered.view(pa.large_binary()))
    if not len(kinds):
        return np.empty(0, np.uint64), which, sizes
    at = np.frombuffer(kinds.buffers()[1], np.int64)[kinds.offset : kinds.offset + len(kinds) + 1]
    data = kinds.buffers()[2].to_pybytes()
    raw, last, digest, each = np.frombuffer(data, np.uint8), at[1:] - 1, xxhash.xxh3_64_intdigest, at.tolist()
    h = np.fromiter((digest(data[a:b], SEED) for a, b in zip(each, each[1:])), np.uint64, len(last))
    of = np.where(np.diff(at) > 1, raw[last - 1].astype(np.int64) << 8, 1 << 16) + raw[last]
    return h & np.uint64((1 << 63) - 256) | np.uint64(1 << 63) | _endings()[of], which, sizes


class Coder:
    """Ranks of texts' frequent tokens and hashes of all others. END comes after each text's words."""

    def __init__(self, table: np.ndarray | None = None):
        table = np.empty(0, np.uint64) if table is None else table
        self.rank = np.argsort(table)
        self.sorted = table[self.rank]

    def of(self, h: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.sorted, h)
        held = at < len(self.sorted)
        held[held] = self.sorted[at[held]] == h[held]
        out = h.copy()
        out[held] = self.rank[at[held]]
        return out

    def all(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ranks or hashes of all texts' tokens one after another, and how many each has."""
        each, sizes = [np.empty(0, np.uint64)], np.ones(len(texts), np.int64)
        for parts, whose in _pieces(texts):
            h, which, n = different(parts)
            each.append(self.of(h)[which])
            np.add.at(sizes, whose, n)
        out = np.full(sizes.sum(), self.of(np.array([END], np.uint64))[0])
        word = np.ones(len(out), bool)
        word[np.cumsum(sizes) - 1] = False
        out[word] = np.concatenate(each)
        return out, sizes


def _pieces(texts: list[bytes]) -> Iterator[tuple[list[bytes], list[int]]]:
    """The texts' parts, about PIECE bytes at once, and the text of each."""
    held, whose, total = [], [], 0
    for k, text in enumerate(texts):
        for part in _parts(text):
            held.append(part)
            whose.append(k)
            total += len(part)
            if total >= PIECE:
                yield held, whose
                held, whose, total = [], [], 0
    if held:
        yield held, whose


def _parts(text: bytes) -> Iterator[bytes]:
    """A text in parts of about CHUNK bytes that end between words."""
    at = 0
    while len(text) - at > CHUNK:
        found = [k for k in (text.find(c, at + CHUNK) for c in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f")) if k >= 0]
        end = min(found, default=len(text))
        yield text[at:end]
        at = end
    yield text[at:]


@dataclass
class Classes:
    """table: the frequent tokens' hashes by rank; count: theirs; group, bin: of each; by_ending: the group of each
    ending; share: log10 of each one's share of its class. unseen, seen: log10 of the share of an unknown token in the last bin of
    each group, and of what a known one's count is to be multiplied by there."""

    table: np.ndarray
    count: np.ndarray
    group: np.ndarray
    bin: np.ndarray
    by_ending: np.ndarray
    share: np.ndarray
    unseen: np.ndarray
    seen: np.ndarray

    def of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each token is in the table, its group and its bin."""
        held = codes < RARE
        at = np.where(held, codes, codes - RARE + len(self.table))
        last = np.full(ENDINGS, BINS - 1)
        return held, np.concatenate([self.group, self.by_ending])[at], np.concatenate([self.bin, last])[at]


def features(codes: np.ndarray, sizes: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Three rows of the weights for each token; before a text's first token stands BEGIN."""
    place = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    back = lambda x, k, none: np.where(place >= k, np.concatenate([np.zeros(k, x.dtype), x])[: len(x)], none)
    hashed = lambda k, x: (scramble(x.astype(np.uint64) + np.uint64(k + 1)) & np.uint64(PART[k] - 1)).astype(np.int64)
    g = [back(group, k, GROUPS) for k in (1, 2, 3)]
    wide = GROUPS + 1
    return np.stack(
        [
            hashed(0, back(codes, 1, BEGIN)),
            hashed(1, back(codes, 2, BEGIN)) + PART[0],
            hashed(2, (g[0] * wide + g[1]) * wide + g[2]) + PART[0] + PART[1],
        ]
    )


@dataclass
class Weights:
    """Of groups (ROWS, GROUPS), of bins within groups (ROWS * GROUPS, BINS), and their biases."""

    group: np.ndarray
    bin: np.ndarray
    group_bias: np.ndarray
    bin_bias: np.ndarray

    @classmethod
    def zero(cls, mass: np.ndarray) -> Weights:
        """mass: tokens of each class. Biases alone give the classes' shares."""
        p = (mass.reshape(GROUPS, BINS) + 1e-3).astype(np.float64)
        bias = np.log(p.sum(axis=1) / p.sum()).astype(np.float32), np.log(p / p.sum(axis=1, keepdims=True)).astype(np.float32)
        return cls(np.zeros((ROWS, GROUPS), np.float32), np.zeros((ROWS * GROUPS, BINS), np.float32), *bias)

    def sums(self, f: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The weights of all groups, and of all bins within the given groups, added up."""
        total = lambda w, at: w.take(at[0], axis=0) + w.take(at[1], axis=0) + w.take(at[2], axis=0)
        z, y = total(self.group, f), total(self.bin, f * GROUPS + group)
        z += self.group_bias
        y += self.bin_bias.take(group, axis=0)
        return z, y

    def chosen(self, f: np.ndarray, group: np.ndarray, bin_: np.ndarray) -> np.ndarray:
        """The log probability of each token's group and bin."""
        out = np.zeros(len(group))
        for at in range(0, len(group), STEP):
            part, g, b = f[:, at : at + STEP], group[at : at + STEP], bin_[at : at + STEP]
            for z, k in zip(self.sums(part, g), (g, b)):
                safe(z)
                own = z.ravel().take(np.arange(len(k)) * z.shape[1] + k)
                out[at : at + STEP] += own - np.log(np.einsum("ij->i", np.exp(z, out=z)))
        return out


def safe(z: np.ndarray) -> None:
    """Takes its maximum from each row, if without that the exponentials might leave what float32 holds."""
    if max(z.max(), -z.min()) > SAFE:
        z -= z.max(axis=1, keepdims=True)


def softmax(z: np.ndarray) -> np.ndarray:
    safe(z)
    np.exp(z, out=z)
    z *= (1 / np.einsum("ij->i", z))[:, None]
    return z


class Sums:
    """What a step adds up: how often each feature's row meets each group and class, and how often it is expected to."""

    def __init__(self, met: np.ndarray, groups: np.ndarray | None = None, bins: np.ndarray | None = None):
        self.met, self.groups, self.bins = met, groups, bins

    def meet(self, f: np.ndarray, group: np.ndarray, bin_: np.ndarray) -> None:
        for rows in f:
            np.add.at(self.met, rows * CLASSES + group * BINS + bin_, 1.0)

    def add(self, f: np.ndarray, group: np.ndarray, bin_: np.ndarray, w: Weights) -> None:
        self.meet(f, group, bin_)
        for at in range(0, len(group), STEP):
            part, g = f[:, at : at + STEP], group[at : at + STEP]
            p, q = map(softmax, w.sums(part, g))
            _scatter(self.groups, part, p)
            _scatter(self.bins, part * GROUPS + g, q)


def _scatter(total: np.ndarray, rows: np.ndarray, p: np.ndarray) -> None:
    """Adds p's rows to those of total (flat, as wide as p) that each of rows names; two numbers at once, as a complex one."""
    pairs, half = p.astype(np.float64).view(np.complex128).ravel(), p.shape[1] // 2
    for own in rows:
        np.add.at(total.view(np.complex128), (own[:, None] * half + np.arange(half)).ravel(), pairs)


def neighbours(codes: np.ndarray, sizes: np.ndarray, total: np.ndarray) -> None:
    """Adds up, for each of the OWN first tokens and each ending of the others (rows), which of the NEIGHBOURS first stands one or two places
    before it (columns)."""
    row = np.where(codes < OWN, codes, np.where(codes < RARE, -1, OWN + codes - RARE))  # the code of a frequent token beyond OWN does not tell its ending
    place = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    for k in (1, 2):
        use = (place[k:] >= k) & (codes[:-k] < NEIGHBOURS) & (row[k:] >= 0)
        np.add.at(total, row[k:][use] * NEIGHBOURS + codes[:-k][use], 1)


def clusters(total: np.ndarray, weight: np.ndarray, rounds: int = 25) -> np.ndarray:
    """The group of each row of counts: k-means of the square roots of the rows' shares. The first centres are the rows farthest from those
    before, among the first rows."""
    x = np.sqrt((total + 1 / NEIGHBOURS) / (total.sum(axis=1, keepdims=True) + 1))
    centres = [x[0]]
    pool = x[: 4 * NEIGHBOURS]
    near = ((pool - centres[0]) ** 2).sum(axis=1)
    for _ in range(GROUPS - 1):
        centres.append(pool[int(near.argmax())])
        near = np.minimum(near, ((pool - centres[-1]) ** 2).sum(axis=1))
    c = np.array(centres)
    for _ in range(rounds):
        group = (x @ c.T - (c * c).sum(axis=1) / 2).argmax(axis=1)
        for g in range(GROUPS):
            if (own := weight[group == g]).sum() > 0:
                c[g] = np.average(x[group == g], axis=0, weights=own)
    return group


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.large_binary()).to_pylist()]


def count_tokens(texts: DataFrame) -> DataFrame:
    """texts: text. Returns h, c: each token's count over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hs, cs = [np.array([END], np.uint64)], [np.array([batch.num_rows])]
            for texts in slices([batch]):
                for parts, _ in _pieces(_texts(texts)):
                    h, which, _ = different(parts)
                    hs.append(h)
                    cs.append(np.bincount(which, minlength=len(h)))
            h, of = np.unique(np.concatenate(hs), return_inverse=True)
            c = np.bincount(of, weights=np.concatenate(cs)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], ["h", "c"])

    return texts.mapInArrow(run, "h long, c long").where("c > 0").groupBy("h").agg(F.sum("c").alias("c"))


ENCODED = "doc_id long, held_out boolean, codes array<int>, rare array<struct<h:long,n:long>>"


def encoded(docs: DataFrame, table: np.ndarray) -> DataFrame:
    """docs: doc_id, text, held_out. A written table of each text's codes, and of its tokens that are not in the table of frequent ones by
    hash and how often they occur; uid numbers the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(table)
        for batch in slices(batches, 256):
            raw, sizes = coder.all(_texts(batch))
            away = raw >= np.uint64(END)
            codes = np.where(away, (raw & np.uint64(0xFF)) + np.uint64(RARE), raw).astype(np.int32)
            whose = np.repeat(np.arange(len(sizes)), sizes)[away]
            order = np.lexsort((raw[away], whose))
            rare, whose = raw[away][order], whose[order]
            fresh = np.ones(len(rare), bool)
            fresh[1:] = (rare[1:] != rare[:-1]) | (whose[1:] != whose[:-1])
            times = np.diff(np.append(np.flatnonzero(fresh), len(rare)))
            pairs = pa.StructArray.from_arrays([pa.array(rare[fresh].view(np.int64)), pa.array(times)], ["h", "n"])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(x) for x in ("doc_id", "held_out")),
                    pa.ListArray.from_arrays(np.append(0, np.cumsum(sizes)).astype(np.int32), pa.array(codes)),
                    pa.ListArray.from_arrays(np.searchsorted(whose[fresh], np.arange(len(sizes) + 1)).astype(np.int32), pairs),
                ],
                ["doc_id", "held_out", "codes", "rare"],
            )

    rows = docs.select("doc_id", "text", "held_out").mapInArrow(run, ENCODED)
    return cut(rows.withColumn("uid", F.monotonically_increasing_id()), "encoded")


def _codes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The codes of a batch's texts one after another, and how many each has."""
    col = batch.column("codes")
    return col.flatten().to_numpy().astype(np.int64), np.diff(col.offsets.to_numpy()).astype(np.int64)


def frequent(counts: DataFrame, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray, int]:
    """Tokens and counts, the most frequent first, of all that occur at least so often: the least power of two, 2 or more, that most or
    fewer tokens reach."""
    size = F.length(F.bin("c"))
    total, bits = 0, 64
    for b, n in sorted((tuple(r) for r in counts.groupBy(size).count().collect()), reverse=True):  # at most 64 rows
        total += n
        if total > most or b < 2:
            break
        bits = b
    got = counts.where(size >= bits).select("h", "c").toArrow()
    h, c = got["h"].to_numpy().view(np.uint64), got["c"].to_numpy()
    order = np.lexsort((h, -c))
    return h[order], c[order], 1 << min(bits - 1, 62)


def added(parts: DataFrame, sizes: dict[str, int]) -> dict[str, np.ndarray]:
    """parts: name, block, part, data (float32 numbers of a block of the named array, as a task has added them up). The arrays' sums
    over all tasks; beyond DIRECT tasks in two steps, so that neither reads more than about the square root of the tasks' rows a block."""
    spark = parts.sparkSession
    several = int(np.sqrt(tasks(spark))) if tasks(spark) > DIRECT else 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(key, total):
            return pa.RecordBatch.from_pylist([dict(zip(("name", "block", "part"), key)) | {"data": total.astype(np.float32).tobytes()}], PARTS)

        key, total = None, None
        for batch in batches:
            for name, block, part, data in zip(*(batch.column(c) for c in ("name", "block", "part", "data"))):
                k, x = (name.as_py(), block.as_py(), part.as_py()), np.frombuffer(data.as_buffer(), np.float32)
                if k == key:
                    total += x
                else:
                    if key:
                        yield row(key, total)
                    key, total = k, x.astype(np.float64)
        if key:
            yield row(key, total)

    for modulus in (several, 1) if several > 1 else (1,):
        keys = ("name", "block", "part")
        dealt = parts.withColumn("part", F.col("part") % modulus).repartition(partitions(spark), *keys).sortWithinPartitions(*keys)
        parts = dealt.mapInArrow(run, "name string, block int, part int, data binary")
    table = cut(parts, "sums")
    got = table.toArrow()  # BLOCKS rows an array
    release(table)
    out = {name: np.zeros(n, np.float32) for name, n in sizes.items()}
    for name, block, data in zip(*(got[c] for c in ("name", "block", "data"))):
        own = out[name.as_py()].reshape(BLOCKS, -1)
        own[block.as_py()] = np.frombuffer(data.as_buffer(), np.float32)
    return out


PARTS = pa.schema([("name", pa.string()), ("block", pa.int32()), ("part", pa.int32()), ("data", pa.binary())])


def _emit(arrays: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """A task's sums as rows for added(); blocks of zeros are left out."""
    part = TaskContext.get().partitionId()
    for name, x in arrays.items():
        for k, block in enumerate(x.reshape(BLOCKS, -1)):
            if block.any():
                yield pa.RecordBatch.from_pylist([{"name": name, "block": k, "part": part, "data": block.astype(np.float32).tobytes()}], PARTS)


#: Tasks whose sums are added in one step.
DIRECT = 256


def tasks(spark: SparkSession) -> int:
    """How many tasks add up at most: four a core, so that what they send is small beside what they read, and one that is lost is soon made again."""
    return 4 * spark.sparkContext.defaultParallelism


def _pass(rows: DataFrame, arrays, see, sizes: dict[str, int]) -> dict[str, np.ndarray]:
    """rows: codes. Each task makes arrays() and lets see(arrays, codes, sizes) add to them; their sums over all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = arrays()
        for batch in slices(batches, 256):
            see(own, *_codes(batch))
        yield from _emit(own)

    few = rows.select("codes").coalesce(tasks(rows.sparkSession))
    return added(few.mapInArrow(run, "name string, block int, part int, data binary"), sizes)


def classes(counts: DataFrame, table: np.ndarray, count: np.ndarray, least: int, rows: DataFrame) -> tuple[Classes, np.ndarray]:
    """rows: codes, of the training texts. The classes, and the training tokens of each."""
    n = (OWN + ENDINGS) * NEIGHBOURS

    def see(own, codes, sizes):
        neighbours(codes, sizes, own["near"])

    near = _pass(rows, lambda: {"near": np.zeros(n)}, see, {"near": n})["near"].reshape(-1, NEIGHBOURS).astype(np.float64)
    first = min(OWN, len(table))
    weight = near.sum(axis=1)
    weight[:first] = count[:first]
    group = clusters(near, np.sqrt(weight))
    by_ending = group[OWN:]
    of_table = by_ending[(table & np.uint64(0xFF)).astype(np.int64)]
    of_table[:first] = group[:first]
    bins = np.full(len(table), BINS - 2)
    for g in range(GROUPS):
        if len(i := np.flatnonzero(of_table[:first] == g)):
            upto = np.cumsum(count[i]) / count[i].sum()
            bins[i] = np.minimum((upto - 1e-9) * (BINS - 2), BINS - 3).astype(np.int64)
    of = of_table * BINS + bins
    mass = np.bincount(of, weights=count, minlength=CLASSES)
    share = np.log10(count / mass[of])
    ending = F.col("h").bitwiseAND(F.lit(0xFF)).cast("int")
    low, c = F.col("c") < least, F.col("c")
    facts = np.zeros((ENDINGS, 4))
    for r in counts.groupBy(ending).agg(  # one row an ending
        F.sum(F.when(low, c).otherwise(0)), F.count_if(c == 1), F.count_if(c == 2), F.sum(F.when(low & (c > 2), c).otherwise(0))
    ).collect():
        facts[r[0]] = [float(x) for x in r[1:]]
    rest, once, twice, more = (np.bincount(by_ending, weights=facts[:, k], minlength=GROUPS) for k in range(4))
    unseen = (once + 0.5) / (once + 2 * twice + more + 1)
    mass.reshape(GROUPS, BINS)[:, BINS - 1] = rest
    return Classes(table, count, of_table, bins, by_ending, share, np.log10(unseen), np.log10((1 - unseen) / np.maximum(rest, 1))), mass


def trained(kinds: Classes, mass: np.ndarray, rows: DataFrame) -> Weights:
    """rows: doc_id, codes, of the training texts."""
    w = Weights.zero(mass)

    def given(codes, sizes):
        _, group, bin_ = kinds.of(codes)
        return features(codes, sizes, group), group, bin_

    def move(met: np.ndarray, expected) -> None:
        """expected: from the first and last row of a part, how often its groups and bins were expected. Part by part, to spare the driver's memory."""
        for a in range(0, ROWS, ROWS // BLOCKS):
            b = a + ROWS // BLOCKS
            own = met[a * CLASSES : b * CLASSES].astype(np.float64)
            groups, bins = expected(a, b)
            ratio = lambda x, y: RATE * np.log((x + DOUBT) / (y + DOUBT))
            w.group[a:b] += ratio(own.reshape(-1, BINS).sum(axis=1), groups).reshape(-1, GROUPS).astype(np.float32)
            w.bin[a * GROUPS : b * GROUPS] += ratio(own, bins).reshape(-1, BINS).astype(np.float32)

    # the first step's expectations follow from the biases and from how often each row is met
    def first(own, codes, sizes):
        Sums(own["met"]).meet(*given(codes, sizes))

    met = _pass(rows, lambda: {"met": np.zeros(ROWS * CLASSES)}, first, {"met": ROWS * CLASSES})["met"]

    def at_first(a, b):
        groups = met[a * CLASSES : b * CLASSES].astype(np.float64).reshape(-1, GROUPS, BINS).sum(axis=2)
        return (groups.sum(axis=1, keepdims=True) * np.exp(w.group_bias)).ravel(), (groups[:, :, None] * np.exp(w.bin_bias)).ravel()

    move(met, at_first)
    del met

    def later(own, codes, sizes):
        Sums(own["met"], own["groups"], own["bins"]).add(*given(codes, sizes), w)

    sizes = {"met": ROWS * CLASSES, "groups": ROWS * GROUPS, "bins": ROWS * CLASSES}
    for k in range(ROUNDS - 1):
        part = rows.where(F.pmod(F.xxhash64(F.col("doc_id")), F.lit(ROUNDS - 1)) == k)
        got = _pass(part, lambda: {name: np.zeros(n) for name, n in sizes.items()}, later, sizes)
        move(got["met"], lambda a, b: (got["groups"][a * GROUPS : b * GROUPS], got["bins"][a * CLASSES : b * CLASSES]))  # noqa: B023
        del got
    return w


@dataclass
class Model:
    """counts: the tokens' counts (h, c), distributed; n and v: all tokens and how many are different."""

    counts: DataFrame
    n: int
    v: int
    kinds: Classes
    weights: Weights


def _fitted(docs: DataFrame) -> tuple[Model, DataFrame]:
    """docs: doc_id, text, held_out. The model of those that are not held out, and all of them encoded by its table."""
    counts = cut(count_tokens(docs.where(~F.col("held_out")).select("text")), "counts")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    table, count, least = frequent(counts)
    rows = encoded(docs, table)
    training = rows.where(~F.col("held_out"))
    kinds, mass = classes(counts, table, count, least, training)
    return Model(counts, n, v, kinds, trained(kinds, mass, training)), rows


def fit(texts: DataFrame) -> Model:
    """texts: doc_id, text; the same rows when read again."""
    model, rows = _fitted(texts.select("doc_id", "text", F.lit(False).alias("held_out")))
    release(rows)
    return model


def score(docs: DataFrame) -> DataFrame:
    """docs: doc_id, text. Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; the model learns from
    the documents that are not held out."""
    return _scored(*_fitted(docs.select("doc_id", "text", is_held_out(F.col("doc_id")).alias("held_out"))))


def score_with(model: Model, docs: DataFrame) -> DataFrame:
    """docs: doc_id, text, held_out (as it is to be returned)."""
    return _scored(model, encoded(docs, model.kinds.table))


def _scored(model: Model, rows: DataFrame) -> DataFrame:
    kinds, w, n, v = model.kinds, model.weights, model.n, model.v
    base = np.log10(kinds.count + 0.1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            codes, sizes = _codes(batch)
            m, d = len(sizes), np.repeat(np.arange(len(sizes)), sizes)
            held, group, bin_ = kinds.of(codes)
            logs, inside = np.zeros(len(codes)), kinds.seen[group]
            logs[held], inside[held] = base[codes[held]], kinds.share[codes[held]]
            inside += w.chosen(features(codes, sizes, group), group, bin_) / np.log(10)
            add = lambda x: np.bincount(d, weights=x, minlength=m)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(x) for x in ("uid", "doc_id", "held_out")),
                    pa.array(sizes),
                    pa.array(add(held).astype(np.int64)),
                    pa.array(add(logs)),
                    pa.array(add(inside)),
                ],
                ["uid", "doc_id", "held_out", "n_tokens", "n_held", "logs", "model"],
            )

    kind = "uid long, doc_id long, held_out boolean, n_tokens long, n_held long, logs double, model double"
    local = cut(rows.select("uid", "doc_id", "held_out", "codes").mapInArrow(run, kind), "local")
    rare = rows.select("uid", F.explode("rare").alias("r")).select("uid", "r.h", "r.n").join(model.counts.select("h", "c"), "h", "left")
    known, times = F.col("c").isNotNull(), F.col("n")
    apart = F.array(*(F.lit(float(x)) for x in (kinds.unseen - kinds.seen)[kinds.by_ending]))  # one number an ending
    lost = F.element_at(apart, F.col("h").bitwiseAND(F.lit(0xFF)).cast("int") + 1)
    rare = rare.groupBy("uid").agg(
        F.sum(F.when(known, times).otherwise(0)).alias("known"),
        F.sum(times * F.log10(F.coalesce("c", F.lit(0)) + 0.1)).alias("more"),
        F.sum(times * F.when(known, F.log10("c")).otherwise(lost)).alias("inner"),
    )
    zero = F.lit(0.0)
    logs = F.col("logs") + F.coalesce("more", zero)
    return local.join(rare, "uid", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_held") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(float(np.log10(n + 0.1 * (v + 1))))).alias("base_score"),
        (F.col("model") + F.coalesce("inner", zero)).alias("score"),
    )
