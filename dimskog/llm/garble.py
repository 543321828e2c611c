"""Text decoded with the wrong character encoding: find the records and restore them.

Latent-chain mixture, fitted by expectation-maximization
--------------------------------------------------------
Every record has, for each encoding chain, a latent bit "this chain damaged the record".  A record
that shows none of the chain's sequences cannot be damaged by it.  For the others the evidence is a
small signature: how usual the best repaired letter is between its neighbours (from letter contexts
counted over *all* texts) and how many sequences there are.  Two emission tables over signatures
(damaged / as written), shared by all records, and a weight of each chain in each source and field are
fitted together, round after round, on aggregated counts.  Weak evidence of one record (a lone sign
that might be meant) is thus pooled with what the same chain does elsewhere in its source.  Each record
is then judged, and each stretch of it repaired, by its own posterior.

Scale: one pass counts letter contexts and rows (bounded by two small alphabets, at most some 10^5 rows
reach the driver), one pass extracts evidence from the few rows that hold a suspect character and keeps
those rows' texts for the repair; everything after that works on counts.  No text is ever shuffled.

Defined results: null texts give no row; empty and clean texts are never found; a replaced character
that no context settles stays U+FFFD in the restored text; repeated rows count each by their own key.
"""

from __future__ import annotations

from collections import Counter
from math import log, log1p

import numpy as np
import re
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimskog.llm import codecs
from dimskog.llm.corpus import map_batches, note_texts
from dimskog.runtime import cut

CONTEXT = re.compile(f"(.?)([{codecs.EXPECTED}])(?=(.?))", re.S)
BINS = (0, 1, 5, 40)  # repaired-letter contexts a million letters: lower edges of the plausibility bins
#: So many of the largest (field, source) pairs have chain weights of their own; the sources of a field beyond them share theirs.
OWN_SOURCES = 1_000
#: A source's weight leans on the corpus's as if it had seen so many more rows.
LEAN = 50
#: A letter so usual (a million letters) is repaired also in a context never seen.
USUAL = 200.0

Context = tuple[str, str, str]


def _near(char: str) -> str:
    """A neighbour as contexts know it: a letter of the Latin blocks, '' for all else."""
    return char if char < "ɐ" and codecs.LETTER.match(char) else ""


def corpus_counts(texts: DataFrame) -> tuple[dict[Context, int], list[tuple[str, str | None, int]], dict[str, int]]:
    """In one pass over all texts: how often each expected letter stands between each pair of neighbours;
    the rows of the OWN_SOURCES largest (tbl, source); the rows of each tbl."""

    def make():
        def step(batch):
            n, rows = Counter(), Counter()
            for tbl, source, t in zip(*(batch.column(i).to_pylist() for i in range(3))):
                rows[tbl, source] += 1
                if not t.isascii():
                    n.update(CONTEXT.findall(t))
            merged = Counter()
            for (a, c, b), k in n.items():
                merged[_near(a), c, _near(b)] += k
            keys = [*merged, *((t, None, s) for t, s in rows)]  # rows are told apart by their null letter
            return {"a": [k[0] for k in keys], "c": [k[1] for k in keys], "b": [k[2] for k in keys], "n": [*merged.values(), *rows.values()]}

        return step

    counts = cut(map_batches(texts.select("tbl", "source", "text"), make, "a string, c string, b string, n long").groupBy("a", "c", "b").agg(F.sum("n").alias("n")))
    seen = {(r.a, r.c, r.b): r.n for r in counts.where("c is not null").collect()}  # bounded: expected letters x (Latin letters + 1)^2
    rows = counts.where("c is null")
    own = [(r.a, r.b, r.n) for r in rows.orderBy(F.desc("n"), "a", "b").limit(OWN_SOURCES).collect()]
    return seen, own, {r.a: r.n for r in rows.groupBy("a").agg(F.sum("n").alias("n")).collect()}  # one row a table


def _rate(seen: dict, total: int, context: Context) -> float:
    left, c, right = context
    if not (left or right) or c not in codecs.EXPECTED:
        return 0.0
    if left.islower() and c.isupper():
        return 0.0
    return seen.get((_near(left), c, _near(right)), 0) * 1e6 / total


def evidence(text: str, seen: dict, total: int) -> list[tuple[str, int, int]]:
    """(chain, best plausibility bin, number of sequences up to 3) of a text that may be damaged."""
    out = []
    if "�" in text:
        out.append((codecs.LOST, 3, min(3, text.count("�"))))
    q = codecs.questions(text)
    if q:
        out.append((codecs.QUESTION, 3, min(3, len(q))))
    chars = set(text)
    for chain in codecs.ALL:
        if codecs.leads(chain).isdisjoint(chars):
            continue
        found = codecs.occurrences(text, chain)
        if chain in codecs.MULTI:
            found = [x for x in found if x[1] - x[0] > 1]
        if found:
            near = codecs.contexts(text, found)
            good = [int(np.searchsorted(BINS, _rate(seen, total, x), "right")) - 1 for x in near]
            top = max(good)
            if chain in codecs.MULTI:
                top = 3 if top else 2
            elif top == 0:
                continue
            out.append((chain, top, min(3, sum(g > 0 for g in good) or len(found))))
    return out


def _features(texts: DataFrame, seen: dict, groups: dict, with_text: bool) -> DataFrame:
    """(tbl, row_id, g, chain, bin, hits, text): one row a record with any evidence, three lists and, if asked, its text."""
    shared = texts.sparkSession.sparkContext.broadcast((seen, groups))  # bounded: see corpus_counts

    def make():
        seen, groups = shared.value
        total = max(1, sum(seen.values()))

        def step(batch):
            rows = []
            for tbl, row, source, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                e = evidence(text, seen, total)
                if e:
                    g = groups.get((tbl, source), groups.get(tbl))
                    rows.append((tbl, row, g, *map(list, zip(*e)), text if with_text else None))
            return {k: [r[i] for r in rows] for i, k in enumerate(("tbl", "row_id", "g", "chain", "bin", "hits", "text"))}

        return step

    near = texts.where(F.col("text").rlike(codecs.SUSPECT))
    return map_batches(near.select("tbl", "row_id", "source", "text"), make, "tbl string, row_id long, g int, chain array<string>, bin array<int>, hits array<int>, text string")


def fit(counts: list[tuple[int, str, int, int, int]], rows: list[int], rounds: int = 25) -> dict[tuple[int, str, int, int], float]:
    """Posterior of (group, chain, bin, hits) by EM over their counts n; ``rows`` has the records of each group.

    E: the posterior of each cell from its group's weight and the two emissions of its signature.  M: the
    emissions from all groups, the weights from each group, leaning on the whole corpus.  The first round
    takes usual repaired letters to speak for damage; the same prior stays as one pseudo-record a signature.
    """
    out = {}
    size = np.array(rows, dtype=float)
    for chain in sorted({c[1] for c in counts}):
        cells = [(g, b, h, k) for g, c, b, h, k in counts if c == chain]
        signatures = sorted({(b, h) for _, b, h, _ in cells})
        at = np.array([signatures.index((b, h)) for _, b, h, _ in cells])
        group, n = np.array([c[0] for c in cells]), np.array([float(c[3]) for c in cells])
        prior = np.array([min(0.97, {1: 0.15, 2: 0.6, 3: 0.9}[max(1, b)] + (0.05 if h > 1 else 0.0)) for b, h in signatures])
        if chain in codecs.MULTI or chain == codecs.LOST:
            prior = np.full(len(signatures), 0.97)
        post = prior[at]
        for _ in range(rounds):
            mass = np.bincount(group, post * n, len(size))
            damaged = mass.sum()
            base = (damaged + 0.5) / (size.sum() + 1.0)
            weight = ((mass + LEAN * base) / (size + LEAN))[group]
            hurt = (np.bincount(at, post * n, len(signatures)) + prior) / (damaged + prior.sum())
            meant = (np.bincount(at, (1 - post) * n, len(signatures)) + (1 - prior)) / (size.sum() - damaged + (1 - prior).sum() + 1.0)
            weight = np.minimum(weight, 1 - 1e-9)
            new = weight * hurt[at] / (weight * hurt[at] + (1 - weight) * meant[at])
            if np.abs(new - post).max() < 1e-6:
                break
            post = 0.5 * post + 0.5 * new
        out.update({(g, chain, b, h): float(p) for (g, b, h, _), p in zip(cells, new)})
    return out


def posteriors(texts: DataFrame, with_text: bool = False) -> tuple[DataFrame, dict, dict]:
    """(records with any evidence, posterior of each of their cells, letter contexts); see ``_features`` and ``fit``."""
    seen, own, rows = corpus_counts(texts)
    groups = {(t, s): i for i, (t, s, _) in enumerate(own)}
    rest = {t: n - sum(k for u, _, k in own if u == t) for t, n in rows.items()}
    groups.update({t: len(own) + i for i, t in enumerate(rest)})
    features = cut(_features(texts, seen, groups, with_text))
    each = features.select("g", F.explode(F.arrays_zip("chain", "bin", "hits")).alias("e"))
    counts = [tuple(r) for r in each.groupBy("g", "e.chain", "e.bin", "e.hits").count().collect()]  # bounded: groups x chains x signatures
    return features, fit(counts, [n for *_, n in own] + list(rest.values())), seen


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with damaged text: the posterior of some chain is at least one half."""
    features, fitted, _ = posteriors(note_texts(spark, sf_dir))
    shared = spark.sparkContext.broadcast(fitted)

    def make():
        damaged = {cell for cell, p in shared.value.items() if p >= 0.5}

        def step(batch):
            tbl, row, g, chain, bins, hits = (batch.column(i).to_pylist() for i in range(6))
            kept = [i for i in range(len(g)) if any((g[i], *e) in damaged for e in zip(chain[i], bins[i], hits[i]))]
            return {"tbl": [tbl[i] for i in kept], "row_id": [row[i] for i in kept]}

        return step

    return map_batches(features.drop("text"), make, "tbl string, row_id long").distinct()


def _stretches(text: str, odds: dict[str, float], seen: dict, total: int, usual: dict[str, float]) -> list[tuple[int, int, str]]:
    """The stretches to replace: of all readings by the record's chains the disjoint ones of most weight.

    A reading weighs the log odds of its chain in this record and how usual its letter is in its place;
    single-byte readings of a letter that is not seen there, nor usual at all, are none.
    """
    readings = []
    for chain, odd in odds.items():
        spans = codecs.repair_spans(text, chain)
        for (s, e, c), context in zip(spans, codecs.contexts(text, spans)):
            rate = _rate(seen, total, context)
            if chain not in codecs.MULTI and c in codecs.EXPECTED and not rate and usual.get(c, 0.0) < USUAL:
                continue
            readings.append((e, s, c, odd + log1p(rate) + 0.1 * log1p(usual.get(c, 0.0)) + (e - s - 1)))
    readings.sort()
    best: list[tuple[float, tuple]] = [(0.0, ())]  # weight of the first k readings, chain of choices
    ends = [r[0] for r in readings]
    from bisect import bisect_right

    for k, (_, s, c, weight) in enumerate(readings):
        before = best[bisect_right(ends, s, 0, k)]
        take = (before[0] + weight, (before[1], k))
        best.append(max(best[-1], take, key=lambda x: x[0]))
    chosen, left = best[-1][1], []
    while chosen:
        chosen, k = chosen
        left.append((readings[k][1], readings[k][0], readings[k][2]))
    return left[::-1]


def restore(text: str, posterior: dict[str, float], seen: dict) -> str:
    """The text as it was written, where the posteriors of its chains and the letter contexts tell.

    Stretches are replaced until none is left (a text may have gone through several chains, one after
    another or side by side); then lost letters are settled by their contexts.
    """
    total = max(1, sum(seen.values()))
    usual = Counter()
    for (_, c, _), n in seen.items():
        usual[c] += n * 1e6 / total
    odds = {c: min(6.0, log(max(p, 1e-9) / max(1 - p, 1e-9))) for c, p in posterior.items() if c in codecs.ALL}
    for _ in range(4):
        spans = _stretches(text, odds, seen, total, usual)
        if not spans:
            break
        text = codecs.splice(text, spans)[0]
    for kind in (codecs.LOST, codecs.QUESTION):
        if kind in posterior:
            text = _settled(text, [(m.start(), m.end()) for m in re.finditer("�+", text)] if kind == codecs.LOST else codecs.questions(text), seen)
    return text


def _settled(text: str, marks: list[tuple[int, int]], seen: dict) -> str:
    """Lost letters that their contexts leave one choice for."""
    spans = []
    for s, e in marks:
        left, right = _near(text[s - 1 : s]), _near(text[e : e + 1])
        votes = Counter({c: seen.get((left, c, right), 0) for c in codecs.EXPECTED})
        (best, most), (_, next_most) = votes.most_common(2)
        if e - s <= 3 and most >= 20 and most >= 9 * next_most:
            spans.append((s, e, best))
    return codecs.splice(text, spans)[0]


def restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tbl, row_id, most probable chain, its posterior and the restored text of every damaged row."""
    features, fitted, seen = posteriors(note_texts(spark, sf_dir), with_text=True)
    shared = spark.sparkContext.broadcast((fitted, seen))

    def make():
        fitted, seen = shared.value

        def step(batch):
            rows = []
            for tbl, row, g, chain, bins, hits, text in zip(*(batch.column(i).to_pylist() for i in range(7))):
                own = {e[0]: p for e in zip(chain, bins, hits) if (p := fitted[(g, *e)]) >= 0.5}
                if own:
                    top = max(own, key=lambda c: (own[c], c))
                    rows.append((tbl, row, top, own[top], restore(text, own, seen)))
            return {k: [r[i] for r in rows] for i, k in enumerate(("tbl", "row_id", "chain", "posterior", "restored"))}

        return step

    return map_batches(features, make, "tbl string, row_id long, chain string, posterior double, restored string")
