"""Document fingerprints from prefix polynomial hashes.

``PrefixHash`` keeps the modular prefix sums ``S[i] = sum c_j r^j (mod p)`` of
a text's code points under two primes.  Two spans are equal when their sums,
shifted to one power of r, are; the longest common extension of two places is
found by binary search over that test.

A fingerprint is the text's length, the two sums of the whole text, and the
prefix sums at a grid of at most ``GRID`` equal steps, the step a power of two
(a longer text's grid is part of a shorter one's).  From the sums at two
neighbouring grid points the span between them can be compared, so stored
fingerprints alone give an estimate (``likeness``): the number of code points
in equal spans at equal places, over the longer length.

While both prefix arrays are at hand, ``PrefixHash.likeness`` is exact about
shifts: the common extensions from both ends are taken off, every ``SEED``
code points of what is left of the shorter text are looked up at all places of
the other, and each place found is extended both ways by binary search.  The
query's columns near_edited and near_next are this one.

The neighbour in descending id order is found without one sorted partition of
everything: ids are cut at quantiles into buckets, each bucket also gets the
first row of the bucket after it, and a sorted pass inside the bucket sees each
document beside the next one.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.llm.common import slices, utf8_cells

PRIMES, BASES = (2147483647, 2147483629), (911382323, 972663749)  # the first is 2^31 - 1; code points times powers stay below 2^52
GRID = 32
SEED = 32  # code points that two texts must share in a row, away from their ends, to count as alike
_WINDOWS = 1 << 16
BUCKETS_PER_PARTITION = 4
FINGERPRINTS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                "near_edited double, near_next double")

_POW = [np.ones(1, np.int64), np.ones(1, np.int64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POW[0]) < n:
        size = max(1 << 14, 1 << (n - 1).bit_length())
        for k, (p, r) in enumerate(zip(PRIMES, BASES)):
            w = np.ones(size, np.int64)
            done = 1
            while done < size:
                step = min(done, size - done)
                w[done:done + step] = w[:step] * (int(w[done - 1]) * r % p) % p
                done += step
            _POW[k] = w
    return _POW


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _longest(holds, most: int) -> int:
    """The largest n up to ``most`` that holds, where all smaller ones do: doubling steps, then binary search."""
    lo, hi = 0, 1
    while hi <= most and holds(hi):
        lo, hi = hi, 2 * hi
    hi = min(hi - 1, most)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if holds(mid) else (lo, mid - 1)
    return lo


class PrefixHash:
    """Prefix arrays of one text; answers span equality and common extensions against any other."""

    def __init__(self, cp: np.ndarray):
        self.n = len(cp)
        self.sums = []
        c = cp.astype(np.int64) + 1
        for p, w in zip(PRIMES, _powers(self.n)):
            s = np.zeros(self.n + 1, np.int64)
            np.cumsum(c * w[: self.n] % p, out=s[1:])  # below 2^31 times the length
            s %= p
            self.sums.append(s)

    def equal(self, i: int, other: "PrefixHash", j: int, length: int) -> bool:
        """Whether the spans of ``length`` code points from i here and from j there are the same."""
        if i + length > self.n or j + length > other.n:
            return False
        for s, o, p, w in zip(self.sums, other.sums, PRIMES, _powers(max(i, j) + 1)):
            a, b = int(s[i + length] - s[i]) % p, int(o[j + length] - o[j]) % p
            if a * int(w[j]) % p != b * int(w[i]) % p:
                return False
        return True

    def common_extension(self, i: int, other: "PrefixHash", j: int) -> int:
        """Length of the longest span that starts at i here and at j there."""
        return _longest(lambda n: self.equal(i, other, j, n), min(self.n - i, other.n - j))

    def common_extension_back(self, i: int, other: "PrefixHash", j: int) -> int:
        """Length of the longest span that ends before i here and before j there."""
        return _longest(lambda n: self.equal(i - n, other, j - n, n), min(i, j))

    def _span_hashes(self, lo: int, hi: int, top: int, stride: int = 1) -> np.ndarray:
        """Sums of the spans of SEED code points from lo, lo + stride, ... before hi, all shifted to the power ``top``, under the first prime."""
        s, p, w = self.sums[0], PRIMES[0], _powers(top + 1)[0]
        x = (s[lo + SEED:hi + SEED:stride] - s[lo:hi:stride] + p) * w[top - hi + 1:top - lo + 1][::-1][::stride]  # below 2^63
        for _ in range(3):  # modulo 2^31 - 1 by adding the upper bits to the lower ones
            x = (x & p) + (x >> 31)
        x[x == p] = 0
        return x

    @staticmethod
    def _first_places(mine: np.ndarray, other: "PrefixHash", lo: int, hi: int, top: int) -> np.ndarray:
        """For each of these span sums its first start in [lo, hi) there, or -1."""
        keys, which = np.unique(mine, return_inverse=True)
        place = np.full(len(keys), -1, np.int64)
        mask = (1 << max(14, (len(keys) * 64).bit_length())) - 1
        known = np.zeros(mask + 1, bool)
        known[keys & mask] = True
        for a in range(lo, hi, _WINDOWS):
            h = other._span_hashes(a, min(hi, a + _WINDOWS), top)
            near = np.flatnonzero(known[h & mask])[::-1]
            at = np.minimum(np.searchsorted(keys, h[near]), len(keys) - 1)
            hit = (keys[at] == h[near]) & (place[at] < 0)
            place[at[hit]] = near[hit] + a  # the first of several is written last
        return place[which]

    def _place(self, i: int, other: "PrefixHash", j: int, hi: int, top: int) -> int:
        """The first true place from j on of the span at i, -1 for none; a chance hit of the sums is passed over."""
        while j >= 0 and not self.equal(i, other, j, SEED):
            j = int(self._first_places(self._span_hashes(i, i + 1, top), other, j + 1, hi, top)[0]) if j + 1 < hi else -1
        return j

    def likeness(self, other: "PrefixHash") -> float:
        """0 to 1: code points of the shorter text in spans shared with the longer one, over the longer length.

        Shared are the common extensions from both ends and, between them, the longest extensions both ways of every
        SEED-th place whose next SEED code points stand anywhere in the other text: at the shift of the extension before,
        or else at their first place.  Two empty texts give 1, one empty text 0.
        """
        if self.n > other.n:
            return other.likeness(self)
        if self.n == 0:
            return float(other.n == 0)
        head = self.common_extension(0, other, 0)
        if head == other.n:
            return 1.0
        tail = min(self.common_extension_back(self.n, other, other.n), self.n - head)
        lo, end, hi = head, self.n - tail, other.n - tail - SEED + 1
        shared = head + tail
        if end - lo < SEED or hi <= lo:
            return shared / other.n
        done = lo  # everything before is counted or given up
        shift = None
        seeds = self._span_hashes(lo, end - SEED + 1, other.n, SEED)
        places = self._first_places(seeds, other, lo, hi, other.n)
        for k in np.flatnonzero(places >= 0).tolist():
            i, j = lo + k * SEED, int(places[k])
            if i + SEED <= done:
                continue
            if shift is not None and lo <= i + shift < hi and self.equal(i, other, i + shift, SEED):
                j = i + shift
            else:
                j = self._place(i, other, j, hi, other.n)
                if j < 0:
                    continue
            shift = j - i
            a = max(done, i - self.common_extension_back(i, other, j))
            b = min(end, i + self.common_extension(i, other, j))
            shared += max(0, b - a)
            done = max(done, b)
        return shared / other.n

    def fingerprint(self) -> str:
        step = grid_step(self.n)
        at = np.arange(step, self.n, step)
        return f"{self.n:x}.{int(self.sums[0][-1]):08x}{int(self.sums[1][-1]):08x}." + \
            self.sums[0][at].astype(">u4").tobytes().hex()


def grid_step(n: int) -> int:
    step = 1
    while n > step * GRID:
        step *= 2
    return step


def parse(fingerprint: str) -> tuple[int, str, np.ndarray]:
    """Length, name of the whole text, prefix sums at the grid's points 0, step, 2 step, ... and the end."""
    n, whole, grid = fingerprint.split(".")
    sums = np.frombuffer(bytes.fromhex(grid), ">u4").astype(np.int64)
    end = [int(whole[:8], 16)] if int(n, 16) else []
    return int(n, 16), whole, np.concatenate([[0], sums, end]).astype(np.int64)


def likeness(a: str, b: str) -> float:
    """From stored fingerprints, 0 to 1: code points in equal grid spans at equal places over the longer length; 1 if equal."""
    if a == b:
        return 1.0
    (n, _, s), (m, _, t) = parse(a), parse(b)
    if n == 0 or m == 0:
        return 0.0
    if n < m:
        n, m, s, t = m, n, t, s
    step, fine = grid_step(n), grid_step(m)
    ratio = step // fine
    if ratio > 1:  # the shorter text's grid, thinned to the longer one's
        last = t[-1:]
        t = t[:-1][::ratio]
        t = np.concatenate([t, last])
    whole = min(n, m) // step  # spans that are whole in both
    p = PRIMES[0]
    same = int((((s[1:whole + 1] - s[:whole]) % p) == ((t[1:whole + 1] - t[:whole]) % p)).sum()) * step if whole else 0
    if n == m and n % step and len(s) == len(t) and (s[-1] - s[-2]) % p == (t[-1] - t[-2]) % p:
        same += n % step
    return min(1.0, same / n)


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n / 2) code points replaced by the first as many (or all) of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _bounds(docs: DataFrame, buckets: int) -> list[int]:
    share = [i / buckets for i in range(1, buckets)]
    cuts = docs.agg(F.percentile_approx("doc_id", share, 100_000).alias("q")).first().q if share else []
    return sorted(set(cuts or []))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprint every text and its edited text; likeness to the edited text and to the next document's text.

    Documents stand in descending id order, nulls last, rows of one id by text (a null text is empty); the next
    document of the last one is the first.  One row per row of ``docs``; a single document is its own next one.
    Equal texts have equal fingerprints and likeness 1; two empty texts too.  Columns other than doc_id and text are ignored, whatever their names.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    cuts = _bounds(base.select("doc_id"), parts * BUCKETS_PER_PARTITION)
    # bucket 0 has the largest ids; the last one has the null ids
    at = np.array(cuts, np.int64)

    @F.pandas_udf("int")
    def number(ids):
        import pandas as pd
        return pd.Series(len(at) - np.searchsorted(at, ids.to_numpy(np.int64)), dtype="int32")
    keyed = base.withColumn("bucket", F.when(F.col("doc_id").isNull(), len(cuts) + 1)
                            .otherwise(number(F.coalesce("doc_id", F.lit(0)))))
    # per bucket the greatest id; at most ``parts * BUCKETS_PER_PARTITION + 1`` rows
    heads = sorted((r.bucket, r.top) for r in keyed.select("bucket", "doc_id").groupBy("bucket").agg(F.max("doc_id").alias("top")).collect())
    if not heads:
        return spark.createDataFrame([], FINGERPRINTS)
    guests = spark.createDataFrame([(b, t, heads[i - 1][0] if i else heads[-1][0]) for i, (b, t) in enumerate(heads)],
                                   "bucket int, top long, host int")
    own = keyed.select("bucket", F.lit(0).alias("guest"), "doc_id", "text")
    k, g = keyed.alias("k"), F.broadcast(guests).alias("g")
    first = (k.join(g, (F.col("k.bucket") == F.col("g.bucket")) & F.col("k.doc_id").eqNullSafe(F.col("g.top")))
             .groupBy(F.col("g.host").alias("bucket")).agg(F.min("k.text").alias("text"), F.first("k.doc_id").alias("doc_id"))
             .select("bucket", F.lit(1).alias("guest"), "doc_id", "text"))

    def scan(batches):
        import pyarrow as pa

        def row(doc_id, text, mine, following, following_hash):
            changed = edited(text, following)
            other = PrefixHash(code_points(changed))
            return (doc_id, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), mine.fingerprint(),
                    other.fingerprint(), mine.likeness(other), mine.likeness(following_hash))
        held = None
        for batch in (part for whole in batches for part in slices(whole, 500)):
            out = []
            for bucket, guest, doc_id, cell in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                                   batch.column(2).to_pylist(), utf8_cells(batch.column(3))):
                text = cell.decode("utf-8", "replace")
                hashed = PrefixHash(code_points(text))
                if held is not None and held[0] == bucket:
                    out.append(row(*held[1:], text, hashed))
                held = None if guest else (bucket, doc_id, text, hashed)
            if out:
                cols = list(zip(*out))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                                 names=[f.split()[0] for f in FINGERPRINTS.split(", ")])

    return (own.unionByName(first).repartition(parts, "bucket")
            .sortWithinPartitions("bucket", "guest", F.desc_nulls_last("doc_id"), "text").mapInArrow(scan, FINGERPRINTS))
