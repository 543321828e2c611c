"""Records of evaluation splits that are also, exactly or almost, in the training split.

Rarity-ordered prefixes
-----------------------
A record becomes its words (mask spans as labels; case, white space and punctuation left aside).  Two
records are the same if a common subsequence holds three quarters of the longer one's words.  Such a
record of n words leaves at most n - ceil(3n/4) of them unmatched, so in one order of all words, the
rare ones first, its first matched word is among its first n - ceil(3n/4) + 1, and is the same word for
both records.  A record is therefore dealt out once for each of these words, its prefix, and every pair
of the two sides that meets at a word is looked at: no pair is lost, however short a record is, wherever
its words differ and however many records share a word.

The second matched word is among the first n - ceil(3n/4) + 2, the third among one more, and matched words
stand in the same order in both texts.  A run of records that meet at a word is therefore split, where that
is less work than to look at all its pairs, by the next matched word and its side of the first, and again.
The words for this travel with the record, so a split moves and writes nothing.  Only a word of more than
HOT_ROWS records, too many for one task, is dealt out together with the second word.

What meets is first held against bounds: the words before the first matched one are unmatched; every word
after it flips one of BITS bits, and two records differ in no more bits than they have unmatched words there.
The longest common subsequence decides on the rest.  The order of words comes from counts of a sample; any
order gives the same pairs, a poor one only more meetings.

The meetings are dealt out in rounds, each for its share of the words, and a round's shuffle files go when its
pairs are written: so the disk in use is a fixed share of the records, however many partitions there are.

Exact copies form one class from the start: a task sends only the first row of a class, its
representative, so a group of copies costs one record a task until its pairs are written.

Defined results: rows with null or blank text or without a known split are no cases; masks that are
null, shifted or overlapping are applied as far as their spans are valid and disjoint; a record that
repeats gives a pair for each of its rows.
"""

from __future__ import annotations

import contextlib
import functools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimskog.llm.corpus import map_batches
from dimskog.runtime import cut, table

#: A word of more records than this is dealt out with a second word.  Both ways are exact; this only moves cost.
HOT_ROWS = 1_000_000
#: Words are ordered by their counts in about so many records; the most frequent ones are known by count.
SAMPLE_ROWS, KNOWN = 20_000, 200_000
#: Bits of the parity of a record's words after a matched one.
BITS = 384
#: Meetings are looked at, and runs split, in blocks of at most so many; a run is split if its pairs are SPLIT times what that makes.
BLOCK, SPLIT = 250_000, 8
#: So many times a run can be split.
DEPTH = 3
#: A round deals out about ROUND_SHARE times the bytes of the records' words; ROUND_WORDS are few enough for one round.
ROUND_SHARE, ROUND_WORDS = 2.5, 1_000_000
#: Pairs go to the texts in shares of the size of the records' words, at PAIR_BYTES each; PAIRS are few enough for one share.
PAIR_BYTES, PAIRS = 300, 1_000_000
#: A partition of the meetings takes the words of records of about so many words in all.
PARTITION_WORDS = 8_000_000
#: Pairs of one record cover so much of the longer one; prefixes, bounds and the decision all take this one value (exact in binary).
COVERAGE = 0.75

_WORD = re.compile(r"\x01?\w+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ENTRY = np.dtype([("id", "<i8"), ("n", "<i4")])
#: lost: words before the matched ones that are not; more: later words sent along, each with its hash and side << 16 and the low bits of its place.
_POST = np.dtype([("key", "<u4"), ("at", "<u4"), ("place", "<u4"), ("lost", "<u4"), ("more", "<u4"), ("bits", "<u8", BITS // 64)])


def words(text: str, spans: list[tuple[int | None, int | None, str | None]]) -> list[str]:
    """The words of a record; each valid mask span (start, end, label) as its label."""
    if spans:
        out, at, n = [], 0, len(text)
        for a, b, label in sorted((a, b, label or "") for a, b, label in spans if a is not None and b is not None):
            if at <= a < b <= n:
                out.append(text[at:a])
                out.append(f" \x01{label} ")
                at = b
        out.append(text[at:])
        text = "".join(out)
    return _WORD.findall(text.lower())


def mask_spans(masks: pa.ListArray) -> list[list[tuple]]:
    """The (start, end, label) spans of each mask of a column, without a Python object for every struct; null masks have none."""
    flat = list(zip(*(masks.values.flatten()[i].to_pylist() for i in range(3)))) if len(masks.values) else []
    ends = masks.offsets.to_pylist()
    return [flat[a:b] if ok else [] for a, b, ok in zip(ends, ends[1:], masks.is_valid().to_pylist())]


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def unmatched(n: np.ndarray) -> np.ndarray:
    """The most words that a record of n words leaves unmatched in a pair."""
    return n - (3 * n + 3) // 4


def ordered(w: np.ndarray, offsets: np.ndarray, known: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Where the words of concatenated records stand, each record's rare ones first; ``known`` words are sorted and have ``counts``."""
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    turn = w.astype(np.uint64)  # one number to sort by: the row, then unknown words by themselves, then known ones by count and word
    if len(known):
        at = np.searchsorted(known, np.arange(1 << 16, dtype=np.uint32) << np.uint32(16))[w >> np.uint32(16)]  # the first with the same high bits
        for _ in range(int(np.bincount(known >> np.uint32(16)).max())):
            at += known[np.minimum(at, len(known) - 1)] < w
        at = np.minimum(at, len(known) - 1)
        rank = np.empty(len(known), dtype=np.uint64)
        rank[np.lexsort((known, counts))] = np.arange(len(known), dtype=np.uint64)
        turn = np.where(known[at] == w, rank[at] | np.uint64(1 << 32), turn)
    return np.argsort(turn | row.astype(np.uint64) << np.uint64(33), kind="stable")  # hot words need no place of their own: any order serves


def prefix_keys(w: np.ndarray, offsets: np.ndarray, known: np.ndarray, counts: np.ndarray, hot: np.ndarray, order: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, place, lost, last) of the words at which concatenated records meet; last: where the key's last word is in the order."""
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(len(sizes)), sizes)
    order = ordered(w, offsets, known, counts) if order is None else order
    w, place = w[order].astype(np.uint64), order - offsets[row]
    rank = np.arange(len(w)) - offsets[row]
    last = unmatched(sizes)[row]  # rank of the last place of the first matched word
    first = np.flatnonzero(rank <= last)
    pairs = np.isin(w[first], hot) & (sizes[row[first]] > 1) if len(hot) else np.zeros(len(first), dtype=bool)
    one, two = first[~pairs], first[pairs]
    n = last[two] + 1 - rank[two]
    x = np.repeat(two, n)
    y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n)
    keys = np.concatenate([_mix(w[one] * _BASE), _mix(_mix(w[x] * _BASE) + w[y])])
    return np.concatenate([row[one], row[x]]), keys, np.concatenate([place[one], place[x]]), np.concatenate([rank[one], rank[y] - 1]), np.concatenate([one, y])


def suffix_bits(w: np.ndarray, offsets: np.ndarray, row: np.ndarray, last: np.ndarray) -> np.ndarray:
    """BITS bits for each word ``last`` of the ordered words of concatenated records, one flipped by every later word of its row."""
    bit = _mix(w.astype(np.uint64) * _BASE + np.uint64(1)) % np.uint64(BITS)
    flips = np.zeros((BITS // 64, len(w) + 1), dtype=np.uint64)
    flips[(bit >> np.uint64(6)).astype(np.int64), np.arange(1, len(w) + 1)] = np.uint64(1) << (bit & np.uint64(63))
    np.bitwise_xor.accumulate(flips, axis=1, out=flips)
    return (flips[:, offsets[row + 1]] ^ flips[:, last + 1]).T


def stretches(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers begin .. begin + n - 1 of each, concatenated."""
    return np.arange(n.sum()) + np.repeat(begin - (np.cumsum(n) - n), n)


def posts_of(w: np.ndarray, offsets: np.ndarray, known: np.ndarray, counts: np.ndarray, hot: np.ndarray, mine=None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, post without key and entry, later words) of the meetings of concatenated records for which ``mine`` of the key holds."""
    with np.errstate(over="ignore"):
        order = ordered(w, offsets, known, counts)
        row, key, place, lost, last = prefix_keys(w, offsets, known, counts, hot, order)
        if mine is not None:
            some = np.flatnonzero(mine(key))
            row, key, place, lost, last = row[some], key[some], place[some], lost[some], last[some]
        w = w[order]
        posts = np.zeros(len(row), dtype=_POST)
        posts["place"], posts["lost"] = place, lost
        posts["bits"] = suffix_bits(w, offsets, row, last)
        # the next matched word is one of the first unmatched - lost + 1 that follow, the one after it may be one further
        more = np.minimum(offsets[row + 1] - 1 - last, unmatched(np.diff(offsets))[row] - lost + DEPTH)
        posts["more"] = more
        at, of = stretches(last + 1, more), np.repeat(np.arange(len(row)), more)
        there = order[at] - offsets[row[of]]
        later = _mix(w[at].astype(np.uint64) * _BASE + (there > place[of])) >> np.uint64(48) << np.uint64(16) | there.astype(np.uint64) & np.uint64(0xFFFF)
    return row, key, posts, later.astype(np.uint32)


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, cls, side, words): words once a class, side and task, as 32 bits of each word's hash.

    Their 16 low bits decide on a coverage: a chance match adds at most a word, far from the threshold.
    """
    rows = (
        table(spark, sf_dir, "sv_pure3")
        .where("split in ('train', 'validation', 'test') and source_text is not null")
        .select("row_id", (F.col("split") != "train").alias("side"), "source_text", "privacy_mask")
    )

    def make():
        import xxhash

        class Memo(dict):
            def __missing__(self, x):
                h = xxhash.xxh64_intdigest(x)
                if len(self) < 2_000_000:
                    self[x] = h
                return h

        memo = Memo()
        seen: set = set()

        def step(batch):
            ids, sides = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts, masks = batch.column(2).to_pylist(), mask_spans(batch.column(3))
            out_id, out_cls, out_side, fresh, flat, sizes = [], [], [], [], [], []
            for i, side, text, mask in zip(ids, sides, texts, masks):
                ws = words(text, mask)
                if not ws:
                    continue
                cls = xxhash.xxh64_intdigest(" ".join(ws)) - (1 << 63)
                out_id.append(i)
                out_cls.append(cls)
                out_side.append(side)
                new = (cls, side) not in seen
                fresh.append(new)
                if new:
                    if len(seen) < 2_000_000:  # only saves work: a class sent twice is merged later
                        seen.add((cls, side))
                    flat.extend(map(memo.__getitem__, ws))
                    sizes.append(len(ws))
            flat, ends = np.array(flat, dtype=np.uint64).astype(np.uint32), np.cumsum(sizes).tolist()
            blobs = iter([flat[b - n : b].tobytes() for n, b in zip(sizes, ends)])
            return {"row_id": out_id, "cls": out_cls, "side": out_side, "words": pa.array([next(blobs) if f else None for f in fresh], pa.binary())}

        return step

    return map_batches(rows, make, "row_id long, cls long, side boolean, words binary")


def reachable(i: int, n: int, j: int, m: int) -> bool:
    """Whether two records of n and m words that meet at words i and j can still reach the coverage; ``run_pairs`` has it for arrays."""
    return min(i, j) + min(n - i, m - j) >= COVERAGE * max(n, m)


def _joined(column: pa.Array, kind: type = np.uint32) -> tuple[np.ndarray, np.ndarray]:
    """The words of a column of records, concatenated, and their offsets."""
    blobs = column.to_pylist()
    return np.frombuffer(b"".join(blobs), kind), np.concatenate([[0], np.cumsum([len(x) // kind().itemsize for x in blobs])]).astype(np.int64)


def _sample(records: DataFrame) -> DataFrame:
    """(keys, each): words << 20 of about SAMPLE_ROWS records, each of which stands for ``each``."""
    each = max(1, records.count() // SAMPLE_ROWS)

    def make():
        def step(batch):
            w, offsets = _joined(batch.column(0))
            return {"keys": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(w.astype(np.int64) << 20))}

        return step

    some = records.where((F.pmod(F.xxhash64("row_id"), F.lit(each)) == 0) & F.col("words").isNotNull()).select("words")
    return map_batches(some, make, "keys array<long>").withColumn("each", F.lit(each))


def _counts(sample: DataFrame) -> DataFrame:
    """(word, n): how often a word stands in all records, estimated."""
    return sample.select(F.explode("keys").alias("k"), "each").groupBy(F.shiftright("k", 20).alias("word")).agg(F.sum("each").alias("n"))


def _hot(sample: DataFrame) -> list[int]:
    """The words of about more than HOT_ROWS records."""
    return [r.word for r in _counts(sample).where(F.col("n") > HOT_ROWS).orderBy(F.desc("n")).limit(KNOWN).collect()]


def run_pairs(posts: np.ndarray, entries: np.ndarray, later: np.ndarray | None = None):
    """Blocks of (train row, evaluation row) of the entries (id: row * 2 + side) that meet at a key and can still be one record."""
    at = posts["at"].astype(np.int64)
    side, n = (entries["id"] & 1).astype(np.uint64)[at], entries["n"][at]
    least = (3 * n + 3) // 4
    most, place, lost, more = n - least, *(posts[x].astype(np.int32) for x in ("place", "lost", "more"))
    begin = np.cumsum(more) - more
    bits = np.ascontiguousarray(posts["bits"].T)  # a row for each 64 bits

    def kept(post, gone, taken, depth, item, start, count):
        """Of the records ``item`` with each of the ``count`` that begin at ``start``."""
        own, mine, left, right = n[post] - gone, least[post], place[post], n[post] - place[post]
        b = stretches(start, count)
        need = np.maximum(np.repeat(mine[item], count), mine[b])
        ok = np.flatnonzero(
            (np.repeat(own[item], count) + own[b] >= 2 * need)
            & (np.minimum(np.repeat(left[item], count), left[b]) + np.minimum(np.repeat(right[item], count), right[b]) >= need)
        )
        a, b, need = np.repeat(item, count)[ok], b[ok], need[ok]
        if depth:  # the last word of the split has a place too; those of long records are not known in full
            i, j = (later[begin[post[x]] + taken[x] - 1].astype(np.int64) & 0xFFFF for x in (a, b))
            reach = np.minimum(i, j) + np.minimum(n[post[a]] - i, n[post[b]] - j) >= need
            ok = np.flatnonzero(reach | (np.maximum(n[post[a]], n[post[b]]) > 0xFFFF) | (taken[a] == 0) | (taken[b] == 0))
            a, b, need = a[ok], b[ok], need[ok]
        a, b = post[a], post[b]
        left = n[a] + n[b] - 2 * need - lost[a] - lost[b]
        for w in bits:  # what one row rules out never sees the next
            left = left - np.bitwise_count(w[a] ^ w[b])
            ok = np.flatnonzero(left >= 0)
            a, b, left = a[ok], b[ok], left[ok]
        both = np.unique(at[a] * len(entries) + at[b])
        return entries["id"][both // len(entries)] >> 1, entries["id"][both % len(entries)] >> 1

    def split(post, key, gone, taken, depth, grow, share, of):
        """What records at a key make at the next matched word; share of: only that part, of a run too large for one go."""
        out = []
        for part in np.split(np.arange(len(post)), np.flatnonzero(np.diff(np.cumsum(grow) // BLOCK)) + 1):
            x = np.repeat(part, grow[part])
            step = stretches(np.zeros(len(part), dtype=np.int64), grow[part])
            new = _mix(_mix(key[x]) + (later[begin[post[x]] + taken[x] + step] >> np.uint32(16)))
            short = part[least[post[part]] <= depth + 2]  # a pair of such records may have no further matched word
            rows = (
                np.concatenate([post[x], post[short]]),
                np.concatenate([new, _mix(_mix(key[short]) + np.uint64(1 << 20))]),
                np.concatenate([gone[x] + step, gone[short]]).astype(np.int32),
                np.concatenate([taken[x] + step + 1, taken[short]]).astype(np.int32),
                np.concatenate([np.zeros(len(x), dtype=bool), np.ones(len(short), dtype=bool)]),
            )
            some = np.flatnonzero(rows[1] % np.uint64(of) == share) if of > 1 else slice(None)
            out.append(tuple(r[some] for r in rows))
        return tuple(np.concatenate(r) for r in zip(*out))

    def looked(post, key, gone, taken, ended, depth):
        order = np.argsort(key << np.uint64(1) | side[post])
        post, key = post[order], key[order]
        edge = np.flatnonzero(np.concatenate([[True], (key[1:] ^ key[:-1]) << np.uint64(1) != 0]))
        ends = np.concatenate([edge[1:], [len(key)]])
        ones = np.add.reduceat(side[post].astype(np.int64), edge)
        zeros = ends - edge - ones
        cross = ones * zeros
        some = np.repeat(cross > 0, ends - edge)  # what meets nothing is left behind
        order, post, key = order[some], post[some], key[some]
        gone, taken, ended = gone[order], taken[order], ended[order]
        zeros, ones, cross, ends = zeros[cross > 0], ones[cross > 0], cross[cross > 0], np.cumsum((ends - edge)[cross > 0])
        edge = ends - zeros - ones
        if not len(edge):
            return
        grow = np.minimum(more[post] - taken, most[post] - gone + 1)
        cost = np.add.reduceat(grow.astype(np.int64), edge)
        further = (cross > SPLIT * cost) & (np.add.reduceat(ended.astype(np.int64), edge) == 0) & (cost > 0) & (later is not None and depth < DEPTH)
        run = np.repeat(np.arange(len(edge)), ends - edge)
        item = np.flatnonzero(~further[run] & (np.arange(len(run)) < (edge + zeros)[run]))
        start, count = (edge + zeros)[run[item]], ones[run[item]]
        for part in np.split(np.arange(len(item)), np.flatnonzero(np.diff(np.cumsum(count) // BLOCK)) + 1):
            yield kept(post, gone, taken, depth, item[part], start[part], count[part])
        further = np.flatnonzero(further)
        for part in np.split(further, np.flatnonzero(np.diff(np.cumsum(cost[further]) // BLOCK)) + 1):
            some = stretches(edge[part], (ends - edge)[part])
            of = -(-int(cost[part].sum()) // (16 * BLOCK))
            for share in range(of):
                rows = split(post[some], key[some], gone[some], taken[some], depth, grow[some], share, of)
                if len(rows[0]):
                    yield from looked(*rows, depth + 1)

    everything = np.arange(len(posts))
    with np.errstate(over="ignore"):
        yield from looked(everything, posts["key"].astype(np.uint64), lost, np.zeros(len(posts), dtype=np.int32), np.zeros(len(posts), dtype=bool), 0)


def _rounds(sample: DataFrame, volume: int, known: np.ndarray, counts: np.ndarray, hot: np.ndarray) -> int:
    """In how many rounds records of so many words are dealt out, by what some records of the sample make."""
    some = [np.array(r.keys) >> 20 for r in sample.select("keys").limit(500).collect()]
    if volume <= ROUND_WORDS or not some:
        return 1
    _, _, posts, later = posts_of(np.concatenate(some).astype(np.uint32), np.concatenate([[0], np.cumsum([len(x) for x in some])]).astype(np.int64), known, counts, hot)
    dealt = len(posts) * (_POST.itemsize + _ENTRY.itemsize) + 4 * len(later)
    return max(1, min(-(-volume // ROUND_WORDS), int(np.ceil(dealt / (4 * sum(map(len, some)) * ROUND_SHARE)))))


@contextlib.contextmanager
def _freed(spark: SparkSession):
    """Shuffle files of a plan made and run here go when it has run."""
    before = spark.conf.get(_FREED, "false")
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREED, before)


def _share(near: DataFrame, share: int, shares: int) -> DataFrame:
    """(a, b) of the packed pairs whose hash falls to the share, each once."""

    def make():
        def step(batch):
            a, b = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
            for n, packed in zip(*(batch.column(i).to_pylist() for i in range(2))):
                x, y = np.frombuffer(pa.decompress(packed, 16 * n, "zstd"), np.int64).reshape(2, n)
                with np.errstate(over="ignore"):
                    mine = _mix(_mix(x.astype(np.uint64) * _BASE) + y.astype(np.uint64)) % np.uint64(shares) == share
                a.append(x[mine])
                b.append(y[mine])
            return {"a": np.concatenate(a), "b": np.concatenate(b)}

        return step

    return map_batches(near, make, "a long, b long").distinct()


def _nominated(records: DataFrame) -> tuple[DataFrame, int]:
    """(n, pairs): packed pairs of representative rows of train and evaluation that meet at a word and are near by their bits; in how many shares they are to be read."""
    spark = records.sparkSession
    volume = records.agg(F.coalesce(F.sum(F.length("words")), F.lit(0))).first()[0] // 4
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), -(-volume // PARTITION_WORDS))
    sample = _sample(records)
    top = sorted((r.word, r.n) for r in _counts(sample).orderBy(F.desc("n"), "word").limit(KNOWN).collect())
    known, counts = np.array([w for w, _ in top], dtype=np.uint32), np.array([n for _, n in top], dtype=np.int64)
    hot = np.array(_hot(sample), dtype=np.uint64)
    rounds = _rounds(sample, volume, known, counts, hot)
    shared = spark.sparkContext.broadcast((known, counts, hot))  # at most KNOWN words

    def dealer(turn):
        def make():
            known, counts, hot = shared.value

            def step(batch):
                w, offsets = _joined(batch.column(2))
                row, key, posts, later = posts_of(w, offsets, known, counts, hot, lambda key: (key >> np.uint64(32)) // np.uint64(parts) % np.uint64(rounds) == turn)
                entries = np.zeros(batch.num_rows, dtype=_ENTRY)
                entries["id"] = batch.column(0).to_numpy() * 2 + batch.column(1).to_numpy(zero_copy_only=False)
                entries["n"] = np.diff(offsets)
                to = (key >> np.uint64(32)) % np.uint64(parts)
                order = np.lexsort((row, to))
                more = posts["more"].astype(np.int64)
                later = later[stretches((np.cumsum(more) - more)[order], more[order])]
                row, key, posts, to = row[order], key[order], posts[order], to[order]
                posts["key"] = key & np.uint64(0xFFFFFFFF)
                upto = np.concatenate([[0], np.cumsum(more[order])])
                buckets, edge = np.unique(to, return_index=True)
                sent, met, words_after = [], [], []
                for a, b in zip(edge, [*edge[1:], len(to)]):  # a record goes once to a partition
                    new = np.concatenate([[True], row[a + 1 : b] != row[a : b - 1]])
                    posts["at"][a:b] = np.cumsum(new) - 1
                    sent.append(entries[row[a:b][new]].tobytes())
                    met.append(posts[a:b].tobytes())
                    words_after.append(later[upto[a] : upto[b]].tobytes())
                return {"bucket": buckets.astype(np.int32), "entries": sent, "posts": met, "later": words_after}

            return step

        return make

    def run(batches):
        entries, posts, later, n = [], [], [], 0
        for batch in batches:
            for e, p, x in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                e, p = np.frombuffer(e, _ENTRY), np.frombuffer(p, _POST).copy()
                p["at"] += n
                n += len(e)
                entries.append(e)
                posts.append(p)
                later.append(np.frombuffer(x, np.uint32))
        if posts:
            entries, posts, later = np.concatenate(entries), np.concatenate(posts), np.concatenate(later)
            for a, b in run_pairs(posts, entries, later):
                if len(a):
                    packed = pa.compress(np.concatenate([a, b]).tobytes(), "zstd", asbytes=True)
                    yield pa.RecordBatch.from_arrays([pa.array([len(a)], pa.int64()), pa.array([packed], pa.binary())], names=["n", "pairs"])

    rows = records.where("words is not null").select("row_id", "side", "words")
    found = []
    for turn in range(rounds):
        with _freed(spark):
            dealt = map_batches(rows, dealer(turn), "bucket int, entries binary, posts binary, later binary")
            found.append(cut(dealt.repartitionById(parts, "bucket").mapInArrow(run, "n long, pairs binary")))
    near = functools.reduce(DataFrame.union, found)
    total = near.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return near, max(1, -(-total // max(PAIRS, 4 * volume // PAIR_BYTES)))


def common_words(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, bit-parallel."""
    at: dict[int, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for y in b:
        p = at.get(y)
        if p:
            u = v & p
            v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def may_cover(x: pa.Array, y: pa.Array) -> np.ndarray:
    """Whether pairs of records can have the coverage, by how often words of each of 1,024 hashes stand in both."""
    count, size = 0, []
    for column, sign in ((x, 1), (y, -1)):
        w, offsets = _joined(column, np.uint16)
        size.append(np.diff(offsets))
        at = np.repeat(np.arange(len(column)), size[-1]) * 1_024 + (w.astype(np.int64) & 1_023)
        count = count + sign * np.bincount(at, minlength=len(column) * 1_024).astype(np.int32)
    return np.abs(count).reshape(-1, 1_024).sum(axis=1) <= size[0] + size[1] - 2 * COVERAGE * np.maximum(*size)


def _covered(pairs: DataFrame) -> DataFrame:
    """(a, b, coverage) of the pairs that are the same record."""

    def make():
        def step(batch):
            out = []
            for k in range(0, batch.num_rows, 2_000):
                part = batch.slice(k, 2_000)
                out += decided(part.filter(pa.array(may_cover(part.column(2), part.column(3)))))
            return {"a": [r[0] for r in out], "b": [r[1] for r in out], "coverage": [r[2] for r in out]}

        def decided(batch):
            out = []
            for a, b, x, y in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if x == y:
                    out.append((a, b, 1.0))
                    continue
                p, q = np.frombuffer(x, np.uint16).tolist(), np.frombuffer(y, np.uint16).tolist()
                longer = max(len(p), len(q))
                need = COVERAGE * longer
                if min(len(p), len(q)) < need:
                    continue
                s = set(q)
                if sum(w in s for w in p) < need:
                    continue
                c = common_words(p, q)
                if c >= need:
                    out.append((a, b, c / longer))
            return out

        return step

    return map_batches(pairs, make, "a long, b long, coverage double")


def _narrow():
    """Words as 16 bits of their hashes, half of what the joins would send."""

    def step(batch):
        return {"row_id": batch.column(0), "words": [np.frombuffer(x, np.uint32).astype(np.uint16).tobytes() for x in batch.column(1).to_pylist()]}

    return step


def _classes(records: DataFrame) -> DataFrame:
    """(p, q, coverage) of every train and evaluation class that are the same record."""

    def texts(side):
        return map_batches(records.where("words is not null").where(side).select("row_id", "words"), _narrow, "row_id long, words binary")

    def covered(share):
        return _covered(
            _share(near, share, shares)
            .join(texts("not side").select(F.col("row_id").alias("a"), F.col("words").alias("x")), "a")
            .join(texts("side").select(F.col("row_id").alias("b"), F.col("words").alias("y")), "b")
            .select("a", "b", "x", "y")
        )

    near, shares = _nominated(records)
    if shares == 1:
        same = covered(0)
    else:
        parts = []
        for share in range(shares):
            with _freed(records.sparkSession):
                parts.append(cut(covered(share)))
        same = functools.reduce(DataFrame.union, parts)
    members = records.select("row_id", "cls")
    return (
        same.join(members.select(F.col("row_id").alias("a"), F.col("cls").alias("p")), "a")
        .join(members.select(F.col("row_id").alias("b"), F.col("cls").alias("q")), "b")
        .groupBy("p", "q")
        .agg(F.max("coverage").alias("coverage"))
    )


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(train_row, eval_row, coverage) of every cross-split pair of one record."""
    records = cut(_records(spark, sf_dir))
    train = records.where("not side").select(F.col("row_id").alias("train_row"), F.col("cls").alias("p"))
    test = records.where("side").select(F.col("row_id").alias("eval_row"), F.col("cls").alias("q"))
    return _classes(records).join(train, "p").join(test, "q").select("train_row", "eval_row", "coverage")


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """row_id_a, row_id_b of every pair, the smaller first."""
    return pairs(spark, sf_dir).select(F.least("train_row", "eval_row").alias("row_id_a"), F.greatest("train_row", "eval_row").alias("row_id_b"))


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per split and source of the evaluation side: rows, rows also in train, pairs and mean best coverage.

    Counted by the sizes of classes: no pair of copies is written out.
    """
    records = cut(_records(spark, sf_dir))
    train = records.where("not side").groupBy(F.col("cls").alias("p")).agg(F.count("*").alias("copies"))
    hits = _classes(records).join(train, "p").groupBy("q").agg(F.sum("copies").alias("pairs"), F.max("coverage").alias("coverage"))
    rows = table(spark, sf_dir, "sv_pure3").where("split in ('validation', 'test')").select("row_id", "split", "source")
    sized = rows.join(records.where("side").select("row_id", "cls"), "row_id", "left").groupBy("split", "source", "cls").agg(F.count("*").alias("rows"))
    hit = F.col("q").isNotNull()
    return (
        sized.join(hits, F.col("cls") == F.col("q"), "left")
        .groupBy("split", "source")
        .agg(
            F.sum("rows").alias("eval_rows"),
            F.coalesce(F.sum(F.when(hit, F.col("rows"))), F.lit(0)).alias("overlapping_rows"),
            F.coalesce(F.sum(F.col("pairs") * F.col("rows")), F.lit(0)).alias("pairs"),
            F.try_divide(F.sum(F.col("coverage") * F.col("rows")), F.sum(F.when(hit, F.col("rows")))).alias("mean_coverage"),
        )
    )
