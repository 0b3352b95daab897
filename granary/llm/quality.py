"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or abstain on each whole text. How often each combination of votes occurs (counted
over all documents; at most 3 to the number of labellers) is all that expectation-maximisation needs to estimate the
share of bad documents and each labeller's accuracy. The combinations' posteriors label a bounded hash sample of documents
(SAMPLE is the bound), on which a linear scorer over hashed features is trained; it scores and judges every document.

Statistics are of whole texts, however long. Defined cases: on a text of fewer than FEW words all labellers abstain and the scorer judges it as any
other; a text without words (a null or empty one too) is kept with the prior as its score; repeated rows are judged alike and are one text in
the sample; other columns are carried (keep_good) or not read (score); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import slices
from .textnum import cuts, scramble

SAMPLE, BINS, THRESHOLD, FEW = 8192, 1 << 13, 0.6, 20
#: Names of the statistics; each has a labeller: (statistic, bad beyond, good within, bad above rather than below).
LABELLERS = (
    ("marked words", 0.3, 0.1, True),
    ("same word twice", 0.25, 0.08, True),
    ("repeated four-word runs", 0.4, 0.2, True),
    ("capital letters", 0.5, 0.25, True),
    ("words without letters", 0.2, 0.08, True),
    ("variety of words", 0.65, 0.8, False),
    ("short words", 0.05, 0.15, False),
    ("sentence ends", 0.002, 0.02, False),
)
_LETTER, _UPPER, _DIGIT, _STOP = (np.zeros(256, bool) for _ in range(4))
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_UPPER[65:91] = True
_DIGIT[48:58] = True
_STOP[[33, 46, 63]] = True
_ENDING = np.zeros(256, bool)  # punctuation that ends ordinary words
_ENDING[[33, 34, 39, 41, 44, 46, 58, 59, 63, 93]] = True
#: Byte classes of the shape features: most punctuation marks are one of their own.
_SHAPE = np.full(256, 1, np.int64)
_SHAPE[97:123], _SHAPE[65:91], _SHAPE[48:58], _SHAPE[128:] = 2, 3, 4, 5
_SHAPE[[9, 10, 11, 12, 13]] = 6
for _k, _c in enumerate(" .,;:!?-'\"()|&%$#*/@_=+<>[]{}~^`\\"):
    _SHAPE[ord(_c)] = 7 + _k


def statistics(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Words of each text, and (texts, labellers) shares. All are of the whole text; variety is the logarithm of the distinct words' number
    to the base of the words', which depends little on a text's length."""
    n = len(texts)
    w = _words(b"\n".join(texts))
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    d = np.searchsorted(begins, w["start"], side="right") - 1
    h, length, letter, upper, digit, last, before = (w[k] for k in ("h", "length", "letter", "upper", "digit", "last", "before"))
    count = lambda mask, at=d: np.bincount(at[mask], minlength=n).astype(np.float64)
    total = lambda x: np.bincount(d, weights=x, minlength=n)
    words, letters = np.bincount(d, minlength=n).astype(np.float64), total(letter)
    strange = ~_LETTER & ~_DIGIT & ~_ENDING
    marked = (length > 2) & (letter > 0) & ((strange[last] & strange[before]) | ((last == before) & (last == 33)))
    repeated = np.zeros(n)
    if len(h) > 3:
        run = scramble(h[:-3] + scramble(h[1:-2] + scramble(h[2:-1] + scramble(h[3:]))))
        one = d[3:] == d[:-3]
        e, again = _again(run[one], d[:-3][one])
        repeated = count(again, e)
    e, again = _again(h, d)
    distinct = count(~again, e)
    sums = np.stack(
        [
            count(marked),
            count((h[1:] == h[:-1]) & (d[1:] == d[:-1]), d[1:]),
            repeated,
            total(upper),
            count(letter + digit == 0),
            np.log(np.maximum(distinct, 1)),
            count((length <= 3) & (letter > 0)),
            count(_STOP[last]),
        ],
        axis=1,
    )
    shares = sums / np.maximum(words, 1)[:, None]
    shares[:, 3] = sums[:, 3] / np.maximum(letters, 1)
    shares[:, 5] = np.where(words > 1, sums[:, 5] / np.log(np.maximum(words, 2)), 1)
    return words, shares


def _words(text: bytes) -> dict[str, np.ndarray]:
    """Each word's place, hash, length, letters, capitals, digits and last two bytes; the text is looked at in slabs, the words are not cut."""
    out = []
    for at, s in cuts(text):
        count = lambda table: np.concatenate([[0], np.cumsum(table[s.buf])])
        of = lambda table: (lambda c: (c[s.end] - c[s.start]).astype(np.int32))(count(table))
        last = s.buf[s.end - 1]
        out.append((s.start + at, s.hashes(), s.end - s.start, of(_LETTER), of(_UPPER), of(_DIGIT), last, s.buf[np.maximum(s.end - 2, s.start)]))
    names = ("start", "h", "length", "letter", "upper", "digit", "last", "before")
    if not out:
        return {k: np.empty(0, np.uint64 if k == "h" else np.int64) for k in names}
    return dict(zip(names, map(np.concatenate, zip(*out))))


def _again(h: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents (at most 2 ** 20), and whether the hash (44 bits of it) was there before in its document, in some order."""
    key = d.astype(np.uint64) << np.uint64(44) | h >> np.uint64(20)
    key.sort()
    again = np.zeros(len(key), bool)
    again[1:] = key[1:] == key[:-1]
    return (key >> np.uint64(44)).astype(np.int64), again


def votes(words: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """1 bad, 0 good, -1 abstains: between the bounds, or on a text of few words."""
    out = np.full(shares.shape, -1)
    for k, (_, bad, good, above) in enumerate(LABELLERS):
        x = shares[:, k] if above else -shares[:, k]
        out[x < (good if above else -good), k] = 0
        out[x > (bad if above else -bad), k] = 1
    out[words < FEW] = -1
    return out


def pattern(v: np.ndarray) -> np.ndarray:
    return ((v + 1) * 3 ** np.arange(v.shape[1])).sum(axis=1)


def unpattern(p: np.ndarray) -> np.ndarray:
    return p[:, None] // 3 ** np.arange(len(LABELLERS)) % 3 - 1


class LabelModel:
    """Two classes, votes independent within a class."""

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, rounds: int = 100):
        v = unpattern(patterns)
        self.bad_share = 0.1
        self.says_bad = np.stack([np.full(v.shape[1], 0.05), np.full(v.shape[1], 0.5)])  # of good, of bad documents
        heard = v >= 0
        p = np.where((v == 1).any(axis=1), 0.9, 0.05)  # to begin with, any vote for bad counts
        for _ in range(rounds if counts.sum() else 0):
            for c, weight in enumerate((counts * (1 - p), counts * p)):
                self.says_bad[c] = ((weight[:, None] * (v == 1)).sum(axis=0) + (0.01, 0.5)[c]) / ((weight[:, None] * heard).sum(axis=0) + 1)
            use = heard.any(axis=1)
            self.bad_share = float(((counts * p)[use].sum() + 0.1) / (counts[use].sum() + 1))
            p = self._posterior(v)

    def _posterior(self, v: np.ndarray) -> np.ndarray:
        q = np.clip(self.says_bad, 1e-6, 1 - 1e-6)
        odds = np.log(self.bad_share / (1 - self.bad_share))
        odds = odds + np.where(v == 1, np.log(q[1] / q[0]), np.where(v == 0, np.log((1 - q[1]) / (1 - q[0])), 0)).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        return self._posterior(unpattern(patterns))


def features(texts: list[bytes], words: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows (offsets, hashed bins, values): shares of the byte-class trigrams, and the step of each
    statistic on a scale of twelve."""
    rows, bins, values = [], [], []
    for k, text in enumerate(texts):
        c = _SHAPE[np.frombuffer(text, np.uint8)]
        if len(c) > 2:
            size = 1 << 18  # the shapes of 64 x 64 x 64 classes
            got = np.bincount(c[:-2] << 12 | c[1:-1] << 6 | c[2:], minlength=1) if len(c) >= size >> 4 else None
            name, n = (np.flatnonzero(got), got[got > 0]) if got is not None else np.unique(c[:-2] << 12 | c[1:-1] << 6 | c[2:], return_counts=True)
            rows.append(np.full(len(name), k))
            bins.append(name)
            values.append(np.sqrt(n / n.sum()))
    steps = np.floor(np.clip(np.nan_to_num(shares), 0, 1) ** 0.5 * 11.999).astype(np.int64)
    use = words >= FEW
    stat = (1 << 18) + np.arange(steps.shape[1]) * 16 + steps
    rows.append(np.repeat(np.flatnonzero(use), steps.shape[1]))
    bins.append(stat[use].ravel())
    values.append(np.full(len(bins[-1]), 0.5))
    r, b, x = map(np.concatenate, (rows, bins, values))
    order = np.argsort(r, kind="stable")
    hashed = (scramble(b[order].astype(np.uint64)) % np.uint64(BINS)).astype(np.int64)
    return np.searchsorted(r[order], np.arange(len(texts) + 1)), hashed, x[order]


def train(offsets: np.ndarray, bins: np.ndarray, values: np.ndarray, target: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Logistic regression on soft labels by full-batch AdaGrad. The last weight is the bias."""
    w, seen = np.zeros(BINS + 1), np.full(BINS + 1, 1e-8)
    if not len(target):
        return w
    row = np.repeat(np.arange(len(target)), np.diff(offsets))
    balance = 0.5 / max(target.mean(), 1e-3) * target + 0.5 / max(1 - target.mean(), 1e-3) * (1 - target)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(margin(offsets, bins, values, w), -50, 50)))
        miss = (p - target) * balance / len(target)
        g = np.append(np.bincount(bins, weights=values * miss[row], minlength=BINS), miss.sum()) + 1e-6 * w
        seen += g * g
        w -= 0.5 * g / np.sqrt(seen)
    return w


def margin(offsets: np.ndarray, bins: np.ndarray, values: np.ndarray, w: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(w[bins] * values)])
    return sums[offsets[1:]] - sums[offsets[:-1]] + w[-1]


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.large_binary()).to_pylist()]


def fit(docs: DataFrame, sample: int = SAMPLE) -> tuple[LabelModel, np.ndarray]:
    """docs: doc_id, text. The label model from all documents, the scorer's weights from the sample."""

    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            p, n = np.unique(pattern(votes(*statistics(_texts(batch)))), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(n)], ["p", "n"])

    rows = docs.select("text").mapInArrow(patterns, "p long, n long").groupBy("p").agg(F.sum("n")).collect()
    seen = np.array(sorted(tuple(r) for r in rows), np.int64).reshape(-1, 2)
    model = LabelModel(seen[:, 0], seen[:, 1])

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = _texts(batch)
            words, shares = statistics(texts)
            offsets, bins, values = features(texts, words, shares)
            lists = lambda x: pa.ListArray.from_arrays(offsets.astype(np.int32), pa.array(x))
            yield pa.RecordBatch.from_arrays(
                [pa.array(pattern(votes(words, shares))), lists(bins.astype(np.int32)), lists(values.astype(np.float32))], ["p", "bins", "values"]
            )

    keep = min(1.0, sample / max(1, int(seen[:, 1].sum())))
    few = docs.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(keep * (1 << 30))).select("text")
    got = few.distinct().mapInArrow(sampled, "p long, bins array<int>, values array<float>").limit(2 * sample).toArrow()  # twice what is expected
    bins, values = (got[c].combine_chunks() for c in ("bins", "values"))
    if not got.num_rows:
        return model, np.zeros(BINS + 1)
    p = got["p"].to_numpy()
    told = (unpattern(p) >= 0).any(axis=1)  # where every labeller abstains there is no label
    sizes = np.diff(bins.offsets.to_numpy())
    flat, val = bins.flatten().to_numpy().astype(np.int64), values.flatten().to_numpy().astype(np.float64)
    use = np.repeat(told, sizes)
    return model, train(np.concatenate([[0], np.cumsum(sizes[told])]), flat[use], val[use], model.posterior(p)[told])


def _judge(model: LabelModel, w: np.ndarray, texts: list[bytes], threshold: float):
    words, shares = statistics(texts)
    posterior = model.posterior(pattern(votes(words, shares)))
    m = margin(*features(texts, words, shares), w)
    none = min(model.bad_share, threshold)  # no words to reject
    bad = np.where(words == 0, none, 1 / (1 + np.exp(-np.clip(m, -50, 50))))
    return bad, posterior, bad <= threshold


def score(docs: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """docs: doc_id, text. Returns doc_id, score (that the text is good), weak_label (the label model's), kept."""
    docs = docs.select("doc_id", "text")
    model, w = fit(docs, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            bad, posterior, kept = _judge(model, w, _texts(batch), threshold)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(1 - bad), pa.array(1 - posterior), pa.array(kept)], ["doc_id", "score", "weak_label", "kept"]
            )

    return docs.mapInArrow(run, "doc_id long, score double, weak_label double, kept boolean")


def keep_good(docs: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """docs without the rows that the scorer rejects; all columns stay."""
    model, w = fit(docs.select("doc_id", "text"), sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array(_judge(model, w, _texts(batch), threshold)[2]))

    return docs.mapInArrow(run, docs.schema)
