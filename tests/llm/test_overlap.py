"""Cross-split overlap against all pairs by brute force."""

import os
import random

import numpy as np
import pyarrow as pa
import pytest

from dimskog.llm import overlap

WORDS = [f"ord{i}" for i in range(400)]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old = 0
        for j, y in enumerate(b, 1):
            old, row[j] = row[j], (old + 1 if x == y else max(row[j], row[j - 1]))
    return row[-1]


def corpus(seed=3, n=60):
    rnd = random.Random(seed)
    rows = []
    phrase = "kallelse skickas till denna adress så snart som möjligt enligt beslut av enheten".split()
    for i in range(n):
        base = [rnd.choice(WORDS) for _ in range(rnd.randint(20, 70))]
        base[5:5] = phrase  # a template that everybody shares
        rows.append((" ".join(base).capitalize() + ".", "train"))
        if i % 4 == 0:
            other = base[:]
            for _ in range(len(other) // 12):
                other[rnd.randrange(len(other))] = "annat"
            rows.append((" ".join(other).upper(), rnd.choice(["validation", "test"])))
        if i % 10 == 0:
            rows.append((" ".join(base), "test"))
            rows.append((" ".join(base), "train"))
    return rows


def test_against_brute_force(spark, tables):
    rows = corpus()
    full = [(i, s, None if i % 7 else "k", t, None) for i, (t, s) in enumerate(rows)]
    full += [(1000, "train", "k", None, None), (1001, "test", "k", " \n", []), (1002, None, "k", rows[0][0], None), (1003, "test", "k", "kort text", None), (1004, "train", "k", "Kort   text!", None)]
    folder = tables(rows=full)
    got = {(r[0], r[1]) for r in overlap.found(spark, folder).collect()}
    words = {r[0]: overlap.words(r[3], []) for r in full if r[3] and r[1]}
    side = {r[0]: r[1] for r in full}
    want = set()
    for a in words:
        for b in words:
            if side[a] == "train" != side[b] and words[a] and words[b]:
                if lcs(words[a], words[b]) >= 0.75 * max(len(words[a]), len(words[b])):
                    want.add((min(a, b), max(a, b)))
    assert got == want and len(want) > 20 and (1003, 1004) in want


def test_masks_count_as_labels(spark, tables):
    tail = " " + " ".join(WORDS[:14])
    rows = [(1, "train", "s", "Anna Ek ringde" + tail, [(0, 7, "NAMN")]), (2, "test", "s", "Bo Al Berg ringde" + tail, [(0, 10, "NAMN"), (5, 6, "X"), (90, 999, "Y"), (None, 3, "Z")])]
    assert overlap.words(rows[0][3], rows[0][4])[:2] == ["\x01namn", "ringde"]
    column = pa.array([[(0, 7, "NAMN"), None], None, [], [(None, 3, None)]], pa.list_(pa.struct([("start_pos", pa.int32()), ("end_pos", pa.int32()), ("label", pa.string())])))
    assert overlap.mask_spans(column) == [[(0, 7, "NAMN"), (None, None, None)], [], [], [(None, 3, None)]] and overlap.mask_spans(column[1:3]) == [[], []]
    assert [tuple(r) for r in overlap.found(spark, tables(rows=rows)).collect()] == [(1, 2)]
    out = overlap.report(spark, tables(rows=rows)).collect()
    assert [(r.split, r.source, r.eval_rows, r.overlapping_rows, r.pairs) for r in out] == [("test", "s", 1, 1, 1)]


def test_empty(spark, tables):
    assert overlap.found(spark, tables()).count() == 0


def test_bit_parallel_lcs():
    rnd = random.Random(5)
    for _ in range(200):
        a, b = [rnd.randrange(6) for _ in range(rnd.randint(1, 40))], [rnd.randrange(6) for _ in range(rnd.randint(1, 40))]
        assert overlap.common_words(a, b) == lcs(a, b)


def test_bound_is_safe():
    rnd = random.Random(6)
    for _ in range(500):
        a, b = [rnd.randrange(9) for _ in range(rnd.randint(4, 30))], [rnd.randrange(9) for _ in range(rnd.randint(4, 30))]
        if lcs(a, b) >= overlap.COVERAGE * max(len(a), len(b)):  # then some aligned meeting point is reachable
            assert any(a[i] == b[j] and overlap.reachable(i, len(a), j, len(b)) for i in range(len(a)) for j in range(len(b)))


def test_hot_prefixes_lose_nothing(spark, tables, monkeypatch):
    """A phrase in every record becomes hot; the same pairs come out."""
    rows = [(i, s, "k", t, None) for i, (t, s) in enumerate(corpus(9, 120))]
    want = {(r[0], r[1]) for r in overlap.found(spark, tables(rows=rows)).collect()}
    monkeypatch.setattr(overlap, "HOT_ROWS", 20)
    monkeypatch.setattr(overlap, "_hot", lambda records: [r.h for r in records.select(overlap.F.explode("keys").alias("k")).select(overlap.F.shiftright("k", 20).alias("h")).groupBy("h").count().where("count > 20").collect()])
    assert {(r[0], r[1]) for r in overlap.found(spark, tables(rows=rows)).collect()} == want and len(want) > 30


def brute(rows):
    """All cross-split pairs of (id, split, words) by the definition."""
    return {(min(i, j), max(i, j)) for i, s, a in rows if s == "train" for j, z, b in rows if z != "train" and lcs(a, b) >= 0.75 * max(len(a), len(b))}


def both_ways(spark, tables, monkeypatch, rows):
    """Pairs found with no word hot, and with all words hot."""
    folder = tables(rows=[(i, s, "k", " ".join(w), None) for i, s, w in rows])
    out = []
    for hot in (10**9, 0):
        monkeypatch.setattr(overlap, "HOT_ROWS", hot)
        out.append({(r[0], r[1]) for r in overlap.found(spark, folder).collect()})
    return out


def test_group_of_near_copies(spark, tables, monkeypatch):
    """40 x 30 variants of one record share every prefix, and differ soon after it."""
    rnd = random.Random(12)
    base = [rnd.choice(WORDS) for _ in range(60)]
    rows = []
    for i in range(70):
        w = base[:]
        for at in rnd.sample(range(60), 6):
            w[at] = f"annat{rnd.randrange(10**6)}"
        rows.append((i, "train" if i < 40 else "test", w))
    want = brute(rows)
    assert len(want) > 1_100
    assert both_ways(spark, tables, monkeypatch, rows) == [want, want]


def test_typo_every_few_words(spark, tables, monkeypatch):
    """Pairs without any long common stretch: every twelfth, and every fourth, word differs."""
    rnd = random.Random(13)
    rows = []
    for i in range(60):
        base = [rnd.choice(WORDS) for _ in range(60)]
        rows.append((3 * i, "train", base))
        for k, step in ((1, 12), (2, 4)):
            rows.append((3 * i + k, "validation", [f"fel{i}" if at % step == step - 1 else x for at, x in enumerate(base)]))
    want = brute(rows)
    assert len(want) == 120
    assert both_ways(spark, tables, monkeypatch, rows) == [want, want]


def test_short_records(spark, tables, monkeypatch):
    """Records of 1 to 34 words with words changed, left out and put in, against all pairs."""
    rnd = random.Random(14)
    rows = []
    for n in range(1, 35):
        for _ in range(4):
            base = [rnd.choice(WORDS) for _ in range(n)]
            rows.append((len(rows), "train", base))
            for _ in range(3):
                w = base[:]
                for _ in range(rnd.randint(0, max(1, n // 4))):
                    at = rnd.randrange(len(w))
                    w[at : at + 1] = rnd.choice(([], ["annat"], [w[at], "till"])) if len(w) > 1 else w
                rows.append((len(rows), "test", w))
    rows += [(10_000 + i, "train" if i % 2 else "test", w.split()) for i, w in enumerate(("a b c d e", "a b x d e", "f g h i j k l", "f g h x j k l", "m n o p", "m n o"))]
    want = brute(rows)
    assert {(10_000, 10_001), (10_002, 10_003), (10_004, 10_005)} <= want and len(want) > 250
    assert both_ways(spark, tables, monkeypatch, rows) == [want, want]


def test_one_threshold(spark, tables, monkeypatch):
    """At three quarters a pair is found, a word below it is none, whether words differ or stand in another order."""
    rows = []
    for k in range(8):
        for turned in (True, False):
            base = [f"s{k}{turned}x{i}" for i in range(20)]
            rows.append((len(rows), "train", base))
            for off in (5, 6):  # 15 and 14 of 20 words in order
                rows.append((len(rows), "test", base[off:] + base[:off] if turned else [f"y{k}x{i}" if i < off else w for i, w in enumerate(base)]))
    want = brute(rows)
    assert want == {(i, i + 1) for i in range(0, 48, 3)}
    assert both_ways(spark, tables, monkeypatch, rows) == [want, want]


def test_prefixes_meet_at_the_threshold():
    """Every random pair that covers three quarters meets at a key and a place it can be reached from, with no word, some and all words hot."""
    rnd = random.Random(15)
    met = 0
    for _ in range(3_000):
        a = [rnd.randrange(rnd.choice((4, 30))) for _ in range(rnd.randint(1, 24))]
        b = [x for x in a if rnd.random() > 0.12] + [rnd.randrange(30) for _ in range(rnd.randint(0, 2))]
        if not b or lcs(a, b) < 0.75 * max(len(a), len(b)):
            continue
        met += 1
        known = np.arange(0, 30, 2, dtype=np.uint32)
        for hot in ([], [2, 3, 7, 11], range(30)):
            with np.errstate(over="ignore"):
                row, key, place = overlap.prefix_keys(np.array(a + b, dtype=np.uint32), np.array([0, len(a), len(a) + len(b)]), known, known[::-1].astype(np.int64) // 4, np.array(hot, dtype=np.uint64))[:3]
            posts = [{(k, p) for r, k, p in zip(row.tolist(), key.tolist(), place.tolist()) if r == side} for side in (0, 1)]
            assert any(k == z and overlap.reachable(i, len(a), j, len(b)) for k, i in posts[0] for z, j in posts[1])
    assert met > 1_000


def test_splits_lose_nothing(monkeypatch):
    """Runs split to the last word in small blocks, or never, with no word, some and all words hot: every pair that covers three quarters is met."""
    rnd = random.Random(16)
    records = []
    for k in range(90):
        base = [rnd.randrange(60 if k % 3 else 9) for _ in range(rnd.choice((1, 2, 3, 4, 6, 12, 30)))]
        for j in range(4):
            records.append((j % 2, [rnd.randrange(60) if rnd.random() < 0.08 * j else x for x in base] + [rnd.randrange(9)] * rnd.randint(0, j % 3)))
    want = {(i, j) for i, (s, a) in enumerate(records) for j, (z, b) in enumerate(records) if s < z and lcs(a, b) >= 0.75 * max(len(a), len(b))}
    offsets = np.concatenate([[0], np.cumsum([len(a) for _, a in records])])
    entries = np.zeros(len(records), dtype=overlap._ENTRY)
    entries["id"], entries["n"] = [2 * i + s for i, (s, _) in enumerate(records)], np.diff(offsets)
    w, known = np.array([x for _, a in records for x in a], dtype=np.uint32), np.arange(0, 60, 2, dtype=np.uint32)
    assert len(want) > 150
    for hot in ([], [2, 3, 7, 11], range(60)):
        row, key, posts, later = overlap.posts_of(w, offsets, known, known[::-1].astype(np.int64) // 4, np.array(hot, dtype=np.uint64))
        posts["key"], posts["at"] = key & np.uint64(0xFFFFFFFF), row
        for split, block in ((0, 50), (0, 10**6), (10**9, 50)):
            monkeypatch.setattr(overlap, "SPLIT", split)
            monkeypatch.setattr(overlap, "BLOCK", block)
            got = {p for a, b in overlap.run_pairs(posts, entries, later) for p in zip(a.tolist(), b.tolist())}
            assert want <= got and len(got) < 3 * len(want)


def test_disk_is_bounded(spark, tables, monkeypatch):
    """Many partitions and hot words on nearly all records: the rounds leave no shuffle files, and the same pairs come out."""
    rows = [(i, s, "k", t, None) for i, (t, s) in enumerate(corpus(17, 200))]
    folder = tables(rows=rows)
    want = {tuple(r) for r in overlap.found(spark, folder).collect()}
    held = 4 * sum(len(overlap.words(r[3], [])) for r in rows)
    dirs = [d.getPath() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def shuffled():
        return {f: os.path.getsize(os.path.join(at, f)) for d in dirs for at, _, files in os.walk(d) for f in files if f.startswith("shuffle_") and f.endswith(".data")}

    monkeypatch.setattr(overlap, "HOT_ROWS", 20)
    monkeypatch.setattr(overlap, "ROUND_WORDS", held // 4 // 6, raising=False)
    before = shuffled()
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = {tuple(r) for r in overlap.found(spark, folder).collect()}
        left = sum(n for f, n in shuffled().items() if f not in before)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == want and len(want) > 50
    assert left < 4 * held


def test_pairs_in_shares(spark, tables, monkeypatch):
    """Pairs that go to the texts share by share are the same, each once."""
    folder = tables(rows=[(i, s, "k", t, None) for i, (t, s) in enumerate(corpus(18, 120))])
    want = sorted(tuple(r) for r in overlap.found(spark, folder).collect())
    shares, covered = [], overlap._covered
    monkeypatch.setattr(overlap, "PAIR_BYTES", 10**9, raising=False)
    monkeypatch.setattr(overlap, "PAIRS", 20, raising=False)
    monkeypatch.setattr(overlap, "_covered", lambda pairs: shares.append(pairs) or covered(pairs))
    assert sorted(tuple(r) for r in overlap.found(spark, folder).collect()) == want and len(want) > 30
    assert len(shares) > 1


def test_long_records_are_not_capped():
    """Positions and lengths beyond 16 bits count in full: 76,000 of 100,000 words are shared."""
    entries = np.zeros(2, dtype=overlap._ENTRY)
    entries["id"], entries["n"] = [2 * 5, 2 * 6 + 1], [100_000, 76_000]
    posts = np.zeros(2, dtype=overlap._POST)
    posts["key"], posts["at"], posts["place"] = 1, [0, 1], [30_000, 10_000]
    assert [(a.tolist(), b.tolist()) for a, b in overlap.run_pairs(posts, entries)] == [([5], [6])]


def test_report_counts_by_class_sizes(spark, tables):
    """Copies on both sides: 3 x 2 pairs, and the same numbers as from the pairs one by one."""
    text = " ".join(WORDS[:30])
    rows = [(i, "train", "s", text, None) for i in range(3)] + [(10 + i, "test", ["u", None][i], text, None) for i in range(2)]
    rows += [(20, "test", "u", "helt annan text här", None), (21, "validation", "u", None, None), (22, "validation", "u", text + " slut", None)]
    out = {(r.split, r.source): (r.eval_rows, r.overlapping_rows, r.pairs, round(r.mean_coverage or 0, 3)) for r in overlap.report(spark, tables(rows=rows)).collect()}
    assert out == {("test", "u"): (2, 1, 3, 1.0), ("test", None): (1, 1, 3, 1.0), ("validation", "u"): (2, 1, 3, 0.968)}


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.01"), reason="needs the test tables")
def test_whole_table_against_all_pairs(spark):
    """Every cross-split pair of the small table, by the definition: a bound from common words, then the subsequence."""
    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/sv_pure3.parquet").where("split in ('train', 'validation', 'test') and source_text is not null").collect()
    known = [(r.row_id, r.split != "train", overlap.words(r.source_text, [tuple(m) for m in r.privacy_mask or () if m])) for r in rows]
    known = [x for x in known if x[2]]
    ids = {w: i for i, w in enumerate({w for _, _, ws in known for w in ws})}
    counts = np.zeros((len(known), len(ids)), dtype=np.uint8)
    for i, (_, _, ws) in enumerate(known):
        np.add.at(counts[i], [ids[w] for w in ws], 1)
    sizes = np.array([len(ws) for _, _, ws in known])
    train = np.flatnonzero([not side for _, side, _ in known])
    want = set()
    for j in (j for j, (_, side, _) in enumerate(known) if side):
        own = np.flatnonzero(counts[j])
        common = np.minimum(counts[np.ix_(train, own)], counts[j, own]).sum(axis=1, dtype=np.int64)
        for i in train[common >= 0.75 * np.maximum(sizes[train], sizes[j])]:
            if overlap.common_words(known[i][2], known[j][2]) >= 0.75 * max(sizes[i], sizes[j]):
                want.add((min(known[i][0], known[j][0]), max(known[i][0], known[j][0])))
    assert {tuple(r) for r in overlap.found(spark, folder).collect()} == want and len(want) > 50
