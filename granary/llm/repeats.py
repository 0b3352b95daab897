"""Removal of repeated windows: a depth-limited radix sort of suffixes by most-significant-digit passes.

A window is the first so many symbols of a suffix: 400 bytes (BYTES) or 51 words (WORDS, whatever white space is between them). Suffixes
are put in equal groups digit by digit, a suffix leaves as soon as its group is one, and no digit beyond a window's length is read:
groups that are still equal at the last symbol are exactly the repeated windows. To keep the passes small they do not look at every suffix
but at anchors: positions whose gram has the least hash of a window. Every window holds an anchor that depends on its symbols alone,
so equal windows meet at equal anchors; this filter loses none. The passes over anchors are

1. the anchor's whole surroundings (all windows it lies in), a digit of 128 bits of BLAKE2b: where they recur, every window in them
   is repeated;
2. the symbols common to the windows that hold the anchor in their first or in their second half, a digit of 64 bits that only says
   which suffixes may be equal: where it does not recur, none of those windows is repeated, and the anchor leaves;
3. the symbols themselves, eight bytes a pass (see msd_sort), for the few anchors left at the borders of repeated passages: first the common
   symbols, then those before and behind them. Equality is that of the symbols; no hash decides here.

Equal texts (by SHA-256) are one text with a count before any pass. Only bytes around the anchors of pass 3 are shuffled, with those of equal
pass-2 digits side by side; groups of more than MANY different surroundings are counted window by window instead, by 128 bits of
BLAKE2b of each.

Symbols are judged on the input. Defined cases: a null text is an empty one; texts shorter than a window keep all; repeated
rows are repeated texts; doc_id may be null and may repeat; other columns are carried (strip) or not read, and may have any names
but those that begin with granary_; an empty table gives no rows. strip and remove read docs more than once and need the same rows each time, in
any order and partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrow import longs, slices
from .common import cut, partitions, release
from .textnum import gram_hashes, numbered, prefix_sums, span_hashes, words_of

PIECE, MANY = 1 << 18, 1 << 16


@dataclass(frozen=True)
class Windows:
    """length: symbols of a window; gram: symbols whose hash picks the anchors; words: symbols are words, not bytes."""

    length: int
    gram: int
    words: bool

    @property
    def reach(self) -> int:
        """An anchor is at most so far into its window."""
        return self.length - self.gram

    @property
    def half(self) -> int:
        return self.reach // 2

    @property
    def wide(self) -> int:
        """Symbols of the windows of one half."""
        return self.length + self.half


BYTES, WORDS = Windows(400, 32, False), Windows(51, 4, True)


@dataclass
class Symbols:
    """of: a number for each symbol; start, end: its bytes in the text (None: symbols are bytes)."""

    of: np.ndarray
    start: np.ndarray | None = None
    end: np.ndarray | None = None


def symbols(texts: list[bytes], kind: Windows) -> list[Symbols]:
    if not kind.words:
        return [Symbols(np.frombuffer(t, np.uint8)) for t in texts]
    start, end, h = words_of(b"\n".join(texts))
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    at = np.searchsorted(start, begins)
    return [Symbols(h[a:b], start[a:b] - s, end[a:b] - s) for a, b, s in zip(at[:-1].tolist(), at[1:].tolist(), begins.tolist())]


def slide(v: np.ndarray, w: int, best=np.minimum) -> np.ndarray:
    """The best of each w neighbours, by spans that double: the base-2 logarithm of w passes, and one for two spans that overlap."""
    n, span = len(v) - w + 1, 1
    if n < 1:
        return v[:0]
    while 2 * span <= w:
        v = best(v[:-span], v[span:])
        span *= 2
    return best(v[:n], v[w - span :])


def _pieces(sizes: list[int], length: int) -> Iterator[list[tuple[int, int, int, int]]]:
    """Lists of (text, offset, first and last window start) whose symbols fit a piece; long texts come in parts with margins."""
    held, total = [], 0
    for k, size in enumerate(sizes):
        for at in range(0, max(0, size - length + 1), PIECE):
            held.append((k, max(0, at - length), at, min(at + PIECE, size - length + 1)))
            total += min(size, PIECE)
            if total >= PIECE:
                yield held
                held, total = [], 0
    if held:
        yield held


FOUND = {"doc": np.int64, "a": np.int64, "left": np.uint64, "right": np.uint64}


def anchors(given: list[Symbols], kind: Windows) -> dict[str, np.ndarray]:
    """doc, a (place), left, right (digits of pass 2 for windows in which the anchor is in the first half and in the second; 0
    where there are none)."""
    out = [{k: np.empty(0, t) for k, t in FOUND.items()}]
    length, gram, reach, half = kind.length, kind.gram, kind.reach, kind.half
    for held in _pieces([len(s.of) for s in given], length):
        parts = [given[k].of[off : end + 2 * length] for k, off, _, end in held]
        buf, sizes = np.concatenate(parts), np.array([len(p) for p in parts])
        start = np.cumsum(sizes) - sizes
        sums = prefix_sums(buf)
        v = gram_hashes(buf, gram, sums) | np.uint64(1)
        least = slide(v, reach + 1)
        open_ = np.zeros(len(least), bool)
        for s, (_, off, first, end) in zip(start.tolist(), held):
            open_[s + first - off : s + end - off] = True
        least[~open_] = 0
        edge = np.zeros(reach, np.uint64)
        most = slide(np.concatenate([edge, least, edge]), reach + 1, np.maximum)
        a = np.flatnonzero(most == v)
        part = np.searchsorted(start, a, side="right") - 1
        begin, end = start[part], start[part] + sizes[part]
        left = span_hashes(buf, a, np.minimum(a + length - half, end), sums) | np.uint64(1)
        left[end - a < length - half] = 0
        right = span_hashes(buf, np.maximum(a - half - 1, begin), a + gram, sums) & ~np.uint64(1)
        right[a - begin < half + 1] = 0
        doc, off = np.array([h[0] for h in held])[part], np.array([h[1] for h in held])[part]
        out.append({"doc": doc, "a": a - begin + off, "left": left, "right": right})
    got = {k: np.concatenate([o[k] for o in out]) for k in out[0]}
    _, first = np.unique(got["doc"] << 32 | got["a"], return_index=True)  # a margin's anchors are its neighbour's too
    return {k: x[first] for k, x in got.items()}


def _around(a: np.ndarray, size: np.ndarray, kind: Windows) -> tuple[np.ndarray, np.ndarray]:
    return np.maximum(0, a - kind.reach), np.minimum(size, a + kind.length)


def digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _whole(texts: list[bytes], given: list[Symbols], doc: np.ndarray, a: np.ndarray, size: np.ndarray, kind: Windows) -> bytes:
    """The digests of the anchors' surroundings one after another; doc is sorted. Where the text begins or ends less than a window away, the
    anchor's place tells it from other surroundings of as many symbols."""
    lo, hi = _around(a, size[doc], kind)
    place, blake, out = np.stack([a - lo, hi - a], axis=1).astype("<u2").tobytes(), hashlib.blake2b, []
    at = np.searchsorted(doc, np.arange(len(texts) + 1)).tolist()
    for text, s, k, upto in zip(texts, given, at, at[1:]):
        first, last = lo[k:upto], hi[k:upto]
        if s.start is not None:
            first, last = s.start[first], s.end[last - 1]
        spans = zip(range(4 * k, 4 * upto, 4), first.tolist(), last.tolist())
        out += [blake(place[p : p + 4] + text[x:y], digest_size=16).digest() for p, x, y in spans]
    return b"".join(out)


def merged(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans that overlap or touch made one, in order."""
    order = np.lexsort((lo, doc))
    doc, lo, hi = doc[order], lo[order], hi[order]
    if not len(doc):
        return doc, lo, hi
    shift = doc.astype(np.int64) << 33
    top = np.maximum.accumulate(hi + shift)
    fresh = np.concatenate([[True], (lo + shift)[1:] > top[:-1]])
    last = np.append(np.flatnonzero(fresh)[1:] - 1, len(doc) - 1)
    return doc[fresh], lo[fresh], (top - shift)[last]


def _bytes(col) -> list[bytes]:
    return [t or b"" for t in col.cast(pa.large_binary()).to_pylist()]


SKETCH = (
    "doc_id long, sha string, t long, size long, own array<struct<lo:long,hi:long>>,"
    "anchors array<struct<a:int,x:long,y:long,left:long,right:long,n:tinyint>>"
)


def _sketch(kind: Windows):
    """Per text its hash, its anchors (one for each surrounding, n at most 2) and the spans that recur within it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = _bytes(batch.column("text"))
            given = symbols(texts, kind)
            size = np.array([len(s.of) for s in given], np.int64)
            sha = [hashlib.sha256(t) for t in texts]
            x = anchors(given, kind)
            x["x"], x["y"] = np.frombuffer(_whole(texts, given, x["doc"], x["a"], size, kind), "<i8").reshape(-1, 2).T
            order = np.lexsort((x["a"], x["y"], x["x"], x["doc"]))
            x = {k: v[order] for k, v in x.items()}
            again = np.zeros(len(order) + 1, bool)
            again[1:-1] = np.logical_and.reduce([x[k][1:] == x[k][:-1] for k in ("doc", "x", "y")])
            recurs = again[:-1] | again[1:]
            d, lo, hi = merged(x["doc"][recurs], *_around(x["a"][recurs], size[x["doc"][recurs]], kind))
            keep = ~again[:-1]
            n = np.where(recurs, 2, 1)[keep].astype(np.int8)
            x = {k: v[keep] for k, v in x.items()}
            lists = lambda doc, **cols: pa.ListArray.from_arrays(
                np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32),
                pa.StructArray.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in cols.values()], list(cols)),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([s.hexdigest() for s in sha], pa.string()),
                    pa.array([int.from_bytes(s.digest()[:8], "big", signed=True) for s in sha], pa.int64()),
                    pa.array(size),
                    lists(d, lo=lo, hi=hi),
                    lists(x["doc"], a=x["a"].astype(np.int32), x=x["x"], y=x["y"], left=x["left"], right=x["right"], n=n),
                ],
                ["doc_id", "sha", "t", "size", "own", "anchors"],
            )

    return run


def text_key(text):
    """The first eight bytes of the text's SHA-256 as a signed long."""
    sha = F.sha2(F.coalesce(text.cast("binary"), F.lit("").cast("binary")), 256)
    part = lambda at: F.conv(F.substring(sha, at, 8), 16, 10).cast("long")
    return F.shiftleft(part(1), 32).bitwiseOR(part(9))


def find(docs: DataFrame, kind: Windows = BYTES) -> tuple[DataFrame, DataFrame]:
    """docs: doc_id, text. Two tables in the shared folder: every row's doc_id, sha, t (text_key), size (symbols), copied (true, or null if
    there is one copy of the text); and the spans to remove from texts of which there is one: t, rep (their doc_id), spans (of
    symbols, in order, apart)."""
    sketch = cut(docs.mapInArrow(_sketch(kind), SKETCH), "sketch")
    one = cut(
        sketch.where(F.col("size") >= kind.length)
        .groupBy("sha")
        .agg(
            F.min("doc_id").alias("rep"),
            F.least(F.count("*"), F.lit(2)).cast("int").alias("copies"),
            F.first(F.struct("t", "size", "own", "anchors")).alias("x"),
        )
        .select("sha", "rep", "copies", "x.*"),
        "texts",
    )
    copies = one.where("copies > 1").select("sha", F.lit(True).alias("copied"))
    rows = cut(sketch.select("doc_id", "sha", "t", "size").join(copies, "sha", "left"), "rows")
    release(sketch)
    seen = one.select("t", "rep", "copies", "size", F.explode("anchors").alias("x")).select("t", "rep", "copies", "size", "x.*")
    times = F.col("copies") * F.col("n")
    unlike = cut(
        seen.groupBy("x", "y")
        .agg(F.sum(times).alias("n"), *(F.first(c).alias(c) for c in ("left", "right", "t", "rep", "a"))),  # all of one row
        "pass1",
    )
    lo, hi = F.greatest(F.col("a") - kind.reach, F.lit(0)), F.least(F.col("a") + kind.length, F.col("size"))
    whole = (
        seen.where("copies = 1")
        .select("t", "rep", "x", "y", lo.cast("long").alias("lo"), hi.cast("long").alias("hi"))
        .join(unlike.where("n > 1").select("x", "y").hint("shuffle_hash"), ["x", "y"])
        .select("t", "rep", "lo", "hi")
    )
    own = one.where("copies = 1").select("t", "rep", F.explode("own").alias("x")).select("t", "rep", "x.*")
    known = cut(_union_of_spans(whole.unionByName(own)), "known")
    release(one)
    both = unlike.select(
        "t", "rep", "a", (F.col("n") == 1).alias("asks"), F.explode(F.array("left", "right")).alias("digit")
    ).where("digit <> 0")
    many = both.groupBy("digit").agg(F.count("*").alias("m"), F.bool_or("asks").alias("any"))
    many = many.where("m > 1 and any").select("digit", (F.col("m") > MANY).alias("hot"))
    wanted = both.join(many.hint("shuffle_hash"), "digit").groupBy("t", "rep").agg(F.collect_list(F.struct("a", "asks", "digit", "hot")).alias("at"))
    text = docs.select(F.col("doc_id").alias("d"), "text", text_key(F.col("text")).alias("k"))
    found = text.join(wanted.hint("shuffle_hash"), (text.k == wanted.t) & text.d.eqNullSafe(wanted.rep)).select("t", "rep", "text", "at")
    around = cut(found.mapInArrow(_surroundings(kind), SURROUNDING), "around")
    release(unlike)
    near = (
        around.where("not hot")
        .repartition(partitions(docs.sparkSession), "digit")
        .sortWithinPartitions("digit")
        .mapInArrow(_solve(kind), "t long, rep long, lo long, hi long")
    )
    windows = around.where("hot").mapInArrow(_windows(kind), "t long, rep long, asks boolean, lo long, x long, y long")
    twice = windows.groupBy("x", "y").agg(F.count("*").alias("m")).where("m > 1").select("x", "y")
    far = windows.where("asks").join(twice, ["x", "y"]).select("t", "rep", "lo", (F.col("lo") + kind.length).alias("hi"))
    listed = known.select("t", "rep", F.explode("spans").alias("s")).select("t", "rep", "s.*")
    spans = cut(_union_of_spans(listed.unionByName(near).unionByName(far)), "spans")
    release(known, around)
    return rows, spans


def _union_of_spans(spans: DataFrame) -> DataFrame:
    """spans: t, rep, lo, hi. t, rep, spans: a text's spans, those that overlap or touch made one."""
    before = Window.partitionBy("t", "rep").orderBy("lo", "hi")
    top = F.max("hi").over(before.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce(F.col("lo") > top, F.lit(True)).cast("int")
    runs = spans.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(before))
    one = runs.groupBy("t", "rep", "run").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return one.groupBy("t", "rep").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("spans"))


SURROUNDING = "t long, rep long, asks boolean, hot boolean, digit long, base long, skip int, bytes binary"


def _surroundings(kind: Windows):
    """For each anchor and half the bytes of the (wide) symbols of its windows. base is their place in the text; where the text begins
    later, skip symbols are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            texts = _bytes(batch.column("text"))
            at = batch.column("at")
            ends = at.offsets.to_numpy()
            sub = at.flatten()
            a, digit = sub.field("a").to_numpy().astype(np.int64), sub.field("digit").to_numpy()
            doc = np.repeat(np.arange(len(texts)), np.diff(ends))
            given = symbols(texts, kind)
            base = a - np.where(digit & 1, kind.half, kind.reach)
            skip = np.maximum(0, -base)
            lo, hi = base + skip, np.minimum(base + kind.wide, np.array([len(s.of) for s in given], np.int64)[doc])
            ends = ends - ends[0]
            data = []
            for text, s, k, upto in zip(texts, given, ends[:-1].tolist(), ends[1:].tolist()):
                first, last = lo[k:upto], hi[k:upto]
                if s.start is not None:
                    first, last = s.start[first], s.end[last - 1]
                data += [text[x:y] for x, y in zip(first.tolist(), last.tolist())]
            cols = [batch.column(c).take(pa.array(doc)) for c in ("t", "rep")] + [sub.field("asks"), sub.field("hot"), pa.array(digit), pa.array(base)]
            for k in range(0, len(data), 4096):
                part = [*(c.slice(k, 4096) for c in cols), pa.array(skip[k : k + 4096].astype(np.int32)), pa.array(data[k : k + 4096], pa.binary())]
                yield pa.RecordBatch.from_arrays(part, ["t", "rep", "asks", "hot", "digit", "base", "skip", "bytes"])

    return run


def matrix(data: list[bytes], skip: np.ndarray, kind: Windows) -> tuple[np.ndarray, np.ndarray]:
    """The symbols as rows (a word is numbered as it comes up, so that equal numbers are equal words), symbol k in column skip + k and
    0 elsewhere; and how many symbols each has."""
    if kind.words:
        first: dict[bytes, int] = {}
        of = np.array([first.setdefault(d, len(first)) for d in data], np.int64)
        which, each, _ = numbered(pa.array(list(first), pa.large_binary()))
        size, start = each[of], (np.cumsum(each) - each)[of]
        flat = (which + 1).astype(np.uint32)[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())]
    else:
        size = np.array([len(d) for d in data], np.int64)
        flat = np.frombuffer(b"".join(data), np.uint8)
    out = np.zeros((len(data), -(-kind.wide // 8) * 8), flat.dtype)
    full = size == kind.wide
    inside = np.repeat(full, size)
    out[full, : kind.wide] = flat[inside].reshape(-1, kind.wide)
    row, some = np.flatnonzero(~full), size[~full]  # at an end of their text
    place = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some - skip[row], some)
    out[np.repeat(row, some), place] = flat[~inside]
    return out, size


def digits(part: np.ndarray) -> np.ndarray:
    """Rows of symbols as rows of eight-byte numbers that sort as the symbols do."""
    each = 8 // part.itemsize
    wide = np.zeros((len(part), -(-part.shape[1] // each) * each), part.dtype.newbyteorder(">"))
    wide[:, : part.shape[1]] = part
    return wide.view(">u8").astype(np.uint64)


def msd_sort(group: np.ndarray, by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Radix sort by most-significant-digit passes within the groups that are given. Returns the rows in order, and for each place
    the first place of the rows that are equal to it. A pass looks only at rows whose group still holds several, and sorts those whose digits differ."""
    order = np.argsort(group, kind="stable")
    label = _firsts(group[order])
    live = np.flatnonzero(_several(label))
    for column in np.ascontiguousarray(by.T):
        if not len(live):
            break
        rows, of = order[live], label[live]
        d = column[rows]
        joined = of[1:] == of[:-1]
        differ = joined & (d[1:] != d[:-1])
        if not differ.any():
            continue
        number = np.concatenate([[0], np.cumsum(~joined)])
        mixed = np.zeros(number[-1] + 1, bool)
        mixed[number[1:][differ]] = True
        at = np.flatnonzero(mixed[number])  # groups of one digit stay as they are
        rows, of, d, places = rows[at], of[at], d[at], live[at]
        sort = np.lexsort((d, of))
        order[places], d = rows[sort], d[sort]
        fresh = np.ones(len(at), bool)
        fresh[1:] = (of[1:] != of[:-1]) | (d[1:] != d[:-1])
        label[places] = places[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
        live = live[_several(label[live])]
    return order, label


def _firsts(x: np.ndarray) -> np.ndarray:
    fresh = np.ones(len(x), bool)
    fresh[1:] = x[1:] != x[:-1]
    return np.maximum.accumulate(np.where(fresh, np.arange(len(x)), 0))


def _several(x: np.ndarray) -> np.ndarray:
    """Sorted x: whether each value is there more than once."""
    same = np.zeros(len(x) + 1, bool)
    same[1:-1] = x[1:] == x[:-1]
    return same[1:] | same[:-1]


def _side(group: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """part: symbols outward from those that each group has in common. The rows in order, and how many symbols each place has in common
    with the one before (-1: another group)."""
    order, _ = msd_sort(group, digits(part))
    a, g = part[order], group[order]
    differ = a[1:] != a[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), part.shape[1])
    return order, np.concatenate([[-1], np.where(g[1:] == g[:-1], common, -1)])


def marks(grid: np.ndarray, skip: np.ndarray, size: np.ndarray, group: np.ndarray, kind: Windows) -> np.ndarray:
    """For each row and each column from 0 to half: whether the window that begins there is another row's of the same group too."""
    length, half, n = kind.length, kind.half, len(grid)
    out = np.zeros((n, half + 1), bool)
    order, label = msd_sort(group, digits(grid[:, half:length]))
    many = _several(label)
    rows, core = order[many], label[many]
    if not len(rows):
        return out
    grid, skip, size = grid[rows], skip[rows], size[rows]
    before, lcb = _side(core, np.ascontiguousarray(grid[:, :half][:, ::-1]))
    behind, lca = _side(core, np.ascontiguousarray(grid[:, length : length + half]))
    begin = np.flatnonzero(_firsts(core) == np.arange(len(core)))
    count = np.diff(np.append(begin, len(core)))
    of = np.repeat(np.arange(len(begin)), count)
    # columns at which a group's marks may differ from the column before: a neighbour comes in or leaves, or a window of a row begins or ends to be there
    when = np.concatenate([half - lcb, lca + 1, skip, skip + size - length + 1])
    event = when * len(begin) + np.concatenate([of, of, of, of])
    event = np.unique(event[(when > 0) & (when <= half) & np.concatenate([lcb >= 0, lca >= 0, np.ones(2 * len(of), bool)])])
    when, which = np.divmod(event, len(begin))
    upto = np.searchsorted(when, np.arange(half + 2))
    left, right = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
    now, marked = np.zeros(len(rows), bool), np.zeros((half + 1, len(rows)), bool)
    for x in range(half + 1):
        g = which[upto[x] : upto[x + 1]] if x else np.arange(len(begin))
        if len(g):
            n = count[g]
            k = np.repeat(begin[g] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            left[before[k]], right[behind[k]] = np.cumsum(lcb[k] < half - x), np.cumsum(lca[k] < x)
            i = k[(skip[k] <= x) & (skip[k] + size[k] >= x + length)]
            key = left[i] * (len(rows) + 1) + right[i]
            by = np.argsort(key)
            now[k] = False
            now[i[by[_several(key[by])]]] = True
        marked[x] = now
    out[rows] = marked.T
    return out


def _solve(kind: Windows):
    """Rows come sorted by digit. A digit's rows are at most MANY."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def solved(t: pa.Table) -> pa.RecordBatch:
            doc, rep, lo, hi = [], [], [], []
            for at, upto in _chunks(longs(t["digit"]), 1 << 14):
                part = t.slice(at, upto - at).combine_chunks()
                skip, base = longs(part["skip"]), longs(part["base"])
                grid, size = matrix(part["bytes"].to_pylist(), skip, kind)
                found = marks(grid, skip, size, longs(part["digit"]), kind) & longs(part["asks"])[:, None]
                r = np.flatnonzero(found.any(axis=1))
                found = found[r]  # a row's windows all overlap: half is less than length
                a = base[r] + found.argmax(axis=1)
                b = base[r] + kind.half - found[:, ::-1].argmax(axis=1) + kind.length
                doc.append(longs(part["t"])[r])
                rep.append(part["rep"].combine_chunks().take(pa.array(r)))
                lo.append(a)
                hi.append(b)
            cat = lambda c: pa.array(np.concatenate(c) if c else np.empty(0, np.int64))
            reps = pa.concat_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in rep]) if rep else pa.array([], pa.int64())
            return pa.RecordBatch.from_arrays([cat(doc), reps, cat(lo), cat(hi)], ["t", "rep", "lo", "hi"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= 1 << 14:
                table = pa.Table.from_batches(held).combine_chunks()
                digit = longs(table["digit"])
                if upto := int(np.flatnonzero(np.diff(digit)).max(initial=-1)) + 1:
                    yield solved(table.slice(0, upto))
                held, rows = table.slice(upto).to_batches(), len(digit) - upto
        if rows:
            yield solved(pa.Table.from_batches(held).combine_chunks())

    return run


def _chunks(digit: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of whole groups of about so many rows."""
    ends = np.append(np.flatnonzero(np.diff(digit)) + 1, len(digit))
    at = 0
    while at < len(digit):
        k = int(np.searchsorted(ends, min(at + most, len(digit))))
        upto = int(ends[k]) if k == 0 or ends[k] - at <= most or ends[k - 1] <= at else int(ends[k - 1])
        yield at, upto
        at = upto


def _windows(kind: Windows):
    """Each window of each row, by its digest."""
    names = ("t", "rep", "asks", "lo", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            out: list[list] = [[] for _ in names]
            for t, rep, asks, base, skip, data in zip(*(batch.column(c).to_pylist() for c in ("t", "rep", "asks", "base", "skip", "bytes"))):
                row = data.split() if kind.words else data
                for x in range(skip, min(kind.half, skip + len(row) - kind.length) + 1):
                    part = row[x - skip : x - skip + kind.length]
                    d = digest(b" ".join(part) if kind.words else part)
                    for o, value in zip(out, (t, rep, asks, base + x, int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True))):
                        o.append(value)
            kinds = (pa.int64(), pa.int64(), pa.bool_(), *[pa.int64()] * 3)
            yield pa.RecordBatch.from_arrays([pa.array(o, k) for o, k in zip(out, kinds)], list(names))

    return run


def cut_out(text: bytes, spans: list) -> tuple[bytes, int]:
    """The bytes outside of the spans (of bytes), and how many maximal runs are gone."""
    at, kept, runs = 0, [], 0
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans):
        if lo > at or not runs:
            kept.append(text[at:lo])
            runs += 1
        at = max(at, hi)
    kept.append(text[at:])
    return b"".join(kept), runs


def remove(docs: DataFrame) -> DataFrame:
    """docs: doc_id, text. Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256: of the bytes of repeated windows of 400 bytes. Beside
    them, n_passage_words: how many words are in repeated windows of 51 words."""
    docs = docs.select("doc_id", "text")
    rows, spans = find(docs, BYTES)
    in_words, passages = find(docs, WORDS)
    text = docs.select(F.col("doc_id").alias("d"), "text", text_key(F.col("text")).alias("k"))
    found = text.join(spans.hint("shuffle_hash"), (text.k == spans.t) & text.d.eqNullSafe(spans.rep)).select("t", "rep", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            got = []
            for text, at in zip(_bytes(batch.column("text")), batch.column("spans").to_pylist()):
                kept, runs = cut_out(text, at)
                got.append((len(text) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
            n, runs, sha = zip(*got) if got else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("t"), batch.column("rep"), pa.array(n, pa.int64()), pa.array(runs, pa.int64()), pa.array(sha, pa.string())],
                ["t", "rep", "n", "runs", "kept"],
            )

    some = found.mapInArrow(run, "t long, rep long, n long, runs long, kept string")
    # one row a text: which of several rows of equal texts it came from does not matter to the words
    words = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["hi"] - s["lo"])
    counted = in_words.select("sha", "t", "size", F.col("copied").isNotNull().alias("all")).distinct()
    counted = counted.join(passages.select("t", words.alias("words")), "t", "left")
    counted = counted.select("sha", F.when(F.col("all"), F.col("size")).otherwise(F.coalesce("words", F.lit(0))).cast("long").alias("n_passage_words"))
    zero, all_ = F.lit(0).cast("long"), F.col("copied").isNotNull()
    return (
        rows.join(some, (rows.t == some.t) & rows.doc_id.eqNullSafe(some.rep), "left")
        .join(counted, "sha")
        .select(
            "doc_id",
            F.col("size").alias("n_bytes"),
            F.when(all_, F.col("size")).otherwise(F.coalesce("n", zero)).alias("n_removed"),
            F.when(all_, F.lit(1).cast("long")).otherwise(F.coalesce("runs", zero)).alias("n_spans"),
            F.when(all_, hashlib.sha256(b"").hexdigest()).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
            "n_passage_words",
        )
    )


def strip(docs: DataFrame, words: bool = False) -> DataFrame:
    """docs with the repeated windows gone from text (and from n_chars, if there; a null text's stays); a character of which bytes were removed
    goes whole. All rows and columns stay. words: windows of 51 words (WORDS) instead of 400 bytes; a passage goes from its first word's
    first byte to its last word's last."""
    names, kind = docs.columns, WORDS if words else BYTES
    rows, spans = find(docs.select("doc_id", "text"), kind)
    keyed = docs.withColumn("granary_k", text_key(F.col("text")))
    whole = rows.where("copied").select("t").distinct().select("t", F.lit(None).cast("long").alias("rep"), F.lit(True).alias("copied"))
    gone = spans.withColumn("copied", F.lit(False)).unionByName(whole, allowMissingColumns=True)
    gone = gone.select(*(F.col(c).alias(f"granary_{c}") for c in ("t", "rep", "spans", "copied")))
    same = (F.col("granary_k") == F.col("granary_t")) & (F.col("granary_copied") | F.col("doc_id").eqNullSafe(F.col("granary_rep")))
    joined = keyed.join(gone.hint("shuffle_hash"), same, "left").select(*(F.col(f"`{n}`") for n in names), "granary_spans", "granary_copied")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            spans, copied = batch.column("granary_spans").to_pylist(), batch.column("granary_copied").to_pylist()
            texts = batch.column("text").to_pylist()
            for k, (t, s, c) in enumerate(zip(texts, spans, copied)):
                if t is not None and (s or c):
                    raw = t.encode()
                    texts[k] = "" if c else cut_out(raw, in_bytes(raw, s, kind))[0].decode(errors="ignore")
            cols = {n: batch.column(n) for n in names}
            cols["text"] = pa.array(texts, pa.string())
            if "n_chars" in cols:
                before = batch.column("n_chars")
                cols["n_chars"] = pa.array([n if t is None else len(t) for t, n in zip(texts, before.to_pylist())], before.type)
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    return joined.mapInArrow(run, docs.schema)


def in_bytes(text: bytes, spans: list, kind: Windows) -> list[dict[str, int]]:
    if not kind.words:
        return spans
    (s,) = symbols([text], kind)
    return [{"lo": int(s.start[x["lo"]]), "hi": int(s.end[x["hi"] - 1])} for x in spans]


_L, _W = BYTES.length, WORDS.length
ORACLE = f"""
with d as (select row_number() over () rid, doc_id, hex(encode(coalesce(text, ''))) h from documents),
  b as (select rid, o, substr(h, 2 * o + 1, 2 * (1000 + {_L - 1})) part from
    (select rid, h, unnest(range(0, length(h) // 2 - {_L - 1}, 1000)) o from d)),
  w as (select rid, o + q p, md5(substr(part, 2 * q + 1, {2 * _L})) k from
    (select *, unnest(range(0, length(part) // 2 - {_L - 1})) q from b)),
  c as (select rid, p from w where k in (select k from w group by k having count(*) > 1)),
  g as (select rid, p, sum(fresh) over (partition by rid order by p) run from
    (select rid, p, case when p - lag(p) over (partition by rid order by p) <= {_L} then 0 else 1 end fresh from c)),
  r as (select rid, min(p) lo, max(p) + {_L} hi from g group by rid, run),
  k as (select rid, sum(hi - lo) gone, count(*) runs, max(hi) last, string_agg(part, '' order by lo) parts from
    (select rid, lo, hi, substr(h, 2 * before + 1, 2 * (lo - before)) part from
      (select *, coalesce(lag(hi) over (partition by rid order by lo), 0) before from r) join d using (rid)) group by rid),
  l as (select row_number() over () rid, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') l from documents),
  y as (select rid, p, md5(array_to_string(l[p + 1:p + {_W}], ' ')) k from (select *, unnest(range(0, len(l) - {_W - 1})) p from l)),
  z as (select rid, p, lead(p) over (partition by rid order by p) - p ahead from y where k in (select k from y group by k having count(*) > 1)),
  q as (select rid, sum(least({_W}, coalesce(ahead, {_W})))::bigint n from z group by rid)
select doc_id, coalesce(q.n, 0) n_passage_words, length(h)::bigint // 2 n_bytes, coalesce(gone, 0)::bigint n_removed, coalesce(runs, 0)::bigint n_spans,
  sha256(unhex(coalesce(parts || substr(h, 2 * last + 1), h))) kept_sha256 from d left join k using (rid) left join q using (rid)"""
