"""Periodic runs, Merkle manifests and source mixtures against plain Python."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripdemand.llm import merkle_manifest as M
from tripdemand.llm import periodic_runs as P
from tripdemand.llm import queries as Q
from tripdemand.llm import row_order as R
from tripdemand.llm import source_mixing as X

CLASHING = "doc_id long, text string, lang string, source string, n_chars long, size string, pos int, digest int, _source int, _part int, copies int, tree int, _text int, start string, rate int"


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def crc(x):
    return zlib.crc32(str(x).encode())


def docs(spark, rows):
    """Documents of (id, text, source) with columns that clash with what the operators make."""
    return spark.createDataFrame([(i, t, None if t is None else "en", s, None if t is None else len(t), "x", 1, 2, 3, 4, 5, 6, 7, "y", 8) for i, t, s in rows], CLASHING)


# Periodic runs ------------------------------------------------------------------


def plain_words(text):
    out, word = [], ""
    for c in text or "":
        if c in " \t\n\x0b\x0c\r":
            out, word = out + [word] * bool(word), ""
        else:
            word += c
    return out + [word] * bool(word)


def plain_runs(w):
    found = []
    for q in range(1, len(w) // 4 + 1):
        t = 0
        while t + q < len(w):
            s = t
            while t + q < len(w) and w[t] == w[t + q]:
                t += 1
            n = t - s + q
            if t > s and n >= max(6, 4 * q) and not any(w[s : s + n - d] == w[s + d : s + n] for d in range(1, q)):
                found.append((s, n, q))
            t = max(t, s + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_result(text):
    w = plain_words(text)
    runs = plain_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    milli = 1000 * best[1] // best[2] if runs else None
    return (len(runs), *best, milli, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def odd_texts(seed, n):
    rng = random.Random(seed)
    for _ in range(n):
        w = [rng.choice(rng.choice(["ab", "abc", "abcdefgh", "a"])) for _ in range(rng.randint(0, 90))]
        for _ in range(rng.randint(0, 2)):
            at, p = rng.randint(0, len(w)), rng.randint(1, 24)
            w[at:] = [w[at + (i - at) % p] if at + (i - at) % p < len(w) else w[i] for i in range(at, len(w))]
        yield rng.choice([" ", "\t", " \n"]).join(w) + rng.choice(["", " "])


EDGES = [None, "", " \n\t", "a", "a a a a a", "a a a a a a", "a b a b a b a", "a b a b a b a b", " a " * 6, "x " * 30_000, "a a a a a a b b b b b b", "é\x85é " * 8]


def test_runs_equal_the_definition(spark):
    texts = EDGES[:9] + EDGES[10:] + list(odd_texts(3, 400)) + ["again again"] * 2
    texts += [" ".join(f"w{i % q}" for i in range(4 * q + extra)) for q in (5, 6, 18, 19, 57, 58, 60) for extra in (-1, 0, 7)]
    got = {r[0]: tuple(r)[1:] for r in P.periodic_runs(docs(spark, [(i, t, "s") for i, t in enumerate(texts)]), [F.col("doc_id")]).collect()}
    assert got == {i: plain_result(t) for i, t in enumerate(texts)}


def test_a_long_run_is_one_run_and_rows_keep_their_columns(spark):
    df = docs(spark, [(None, "x " * 30_000, "s"), (1, None, "s"), (1, None, "s")])
    got = P.periodic_runs(df, [F.col("doc_id"), F.col("_part")])
    assert got.columns[:2] == ["doc_id", "_part"]
    rows = sorted(map(tuple, got.collect()), key=lambda r: r[0] is not None)
    assert rows[0][:7] == (None, 4, 1, 0, 30_000, 1, 30_000_000)
    assert rows[0][-1] == sha("x") and rows[1] == rows[2] == (1, 4, 0, None, None, None, None, sha(""), sha(""))
    assert P.periodic_runs(df.limit(0), [F.col("doc_id")]).count() == 0


def test_pairs_and_lines_grow_with_the_words_not_their_squares():
    words = np.zeros(200_000, np.int64)
    start, length, period = P.find_runs(words)
    assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [200_000], [1])


def test_covered_pairs_are_not_extended_again():
    words = np.array([9, 1, 2, 1, 2, 1, 2, 1, 2, 8])
    begin, end, lag = P.extended(words, np.array([2, 1]), np.array([2, 2]), 5)
    assert (begin.tolist(), end.tolist(), lag.tolist()) == ([1], [7], [2])
    begin, end, lag = P.extended(words, np.array([3]), np.array([2]), 2)  # grows to both sides
    assert (begin.tolist(), end.tolist()) == ([1], [7])


def test_repeated_tails(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(0, 60))) if i % 7 else None, "s") for i in range(400)]
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    got = {r.doc_id: r.out for r in docs(spark, rows).select("doc_id", P.with_repeated_tail(F.col("text"), number).alias("out")).collect()}
    changed = 0
    for i, t, _ in rows:
        w = plain_words(t)
        h, n = crc(i), len(w)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
            changed += 1
        assert plain_words(got[i]) == w
        assert (got[i] is None) == (t is None)
    assert changed > 10


# Merkle manifest ----------------------------------------------------------------


def up(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def siblings(levels, at):
    for level in levels[:-1]:
        first = at // 3 * 3
        yield "".join(level[first:at]), "".join(level[at + 1 : first + 3])
        at //= 3


def plain_leaf(i, source, lang, n, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))


def plain_manifest(rows):
    """Sorted results of (id, text, source) rows whose ids may repeat or be null."""
    trees = defaultdict(list)
    for i, t, s in rows:
        lang, n = (None, None) if t is None else ("en", len(t))
        other = t.replace("\n", "") if t is not None and i is not None and crc(i) % 2 == 0 else t
        trees[s].append((i, plain_leaf(i, s, lang, n, t), plain_leaf(i, s, lang, n, other)))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    levels = {}
    for s in order:
        trees[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        levels[s] = up([x[1] for x in trees[s]])
    top = up([levels[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for at, (i, leaf, claim) in enumerate(trees[s]):
            path = [*siblings(levels[s], at), *siblings(top, k)]
            for a, b in path:
                claim = sha(a + claim + b)
            out.append((i, leaf, levels[s][-1][0], top[-1][0], sha("".join(a + b for a, b in path)), claim, claim == top[-1][0]))
    return sorted(out, key=repr)


def manifest(spark, rows):
    df = docs(spark, rows)
    tampered = F.when(Q.checksum(F.col("doc_id")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return M.merkle_proofs(df, ["doc_id", "source", "lang", "n_chars", "text"], [F.col("doc_id")], {"text": tampered})


@pytest.mark.parametrize("deep", [1, 2, 7])
def test_manifest_equals_the_definition(spark, monkeypatch, deep):
    monkeypatch.setattr(M, "DEEP", deep)
    monkeypatch.setattr(M, "BLOCK", 3**deep)
    rng = random.Random(deep)
    rows = [(i, rng.choice([None, "", "a\nb", f"é {i}\n", "plain"]), rng.choice(["a", "a", "a", "é", "\U0001f600", "", None, "Z"])) for i in range(150)]
    rows += [(7, "same", "a"), (7, "same", "a"), (7, "other", "a"), (None, "x\n", "a"), (200, "alone\n", "one")]
    assert sorted(map(tuple, manifest(spark, rows).collect()), key=repr) == plain_manifest(rows)


@pytest.mark.parametrize("rows", [[], [(4, "a\nb", None)], [(i, "t\n", f"s{i}") for i in range(10)]])
def test_manifest_of_few_rows(spark, rows):
    got = manifest(spark, rows)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_manifest(rows)


def test_missing_nodes_are_the_least_that_prove():
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randint(1, 60)
        have = sorted(rng.sample(range(n), rng.randint(1, n)))
        need = M.missing(np.array(have), n)
        assert len(need) == len(set(need))
        levels = up([str(i) for i in range(n)])
        known = {(0, 0, p): levels[0][p] for p in have} | {(0, v, p): levels[v][p] for v, p in need}
        given = len(known)
        steps = M.derive(known, 0, np.array(have), n)
        assert known[0, len(steps), 0] == levels[-1][0]
        assert len(known) >= given  # nothing given was derived again
        assert not {(0, v, p) for v, p in need} & {(0, v, p) for v in range(len(levels)) for p in {h // 3**v for h in have}}


def test_places(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(40), None, rng.choice(["a", "a", "b", None])) for _ in range(500)]
    got = R.places(docs(spark, rows).select("doc_id", "source").repartition(7), [F.col("doc_id")], "source").collect()
    for s in ("a", "b", None):
        own = sorted((r.pos, r.doc_id, r["size"]) for r in got if r.source == s)
        assert [p for p, _, _ in own] == list(range(len(own))) and {n for _, _, n in own} == {len(own)}
        assert [d for _, d, _ in own] == sorted(d for d, _, x in rows if x == s)


# Source mixing ------------------------------------------------------------------


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, free, left = {}, set(order), Fraction(sum(sizes.values()))
    while free:
        unit = left / sum(weight[s] for s in free)
        over = {s for s in free if 3 * sizes[s] <= unit * weight[s]}
        if not over:
            return target | {s: unit * weight[s] for s in free}
        for s in over:
            target[s] = Fraction(3 * sizes[s])
            left -= target[s]
        free -= over
    return target


@pytest.mark.parametrize("seed", range(6))
def test_targets_equal_the_definition(spark, seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice([0, 1, 10, rng.randrange(10**4), rng.randrange(10**9)]) for s in ["", "a", "b", "B", "é", "\U0001f600", "￿", None][: rng.randint(1, 8)]}
    got = X.targets(X.weighted(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))).collect()
    want = plain_targets(sizes)
    assert len(got) == len(sizes)
    for r in got:
        assert r.target == pytest.approx(float(want[r.source]), rel=1e-12)
        assert r.target <= 3 * r.source_size
    assert sum(r.target for r in got) == pytest.approx(sum(sizes.values()))


def mixed_rows():
    rng = random.Random(9)
    rows = [(i, " ".join(["w"] * rng.randint(0, 40)), "hot" if i % 3 == 0 else rng.choice(["b", "c", "d", None])) for i in range(6000)]
    return rows + [(None, None, "empty"), (1, None, "empty"), (2, "  \t", "b"), (3, "w w", "b"), (3, "w w", "b")]


def test_mixture(spark):
    rows = mixed_rows()
    df = docs(spark, rows)
    got = X.repetitions(df, [F.col("doc_id"), F.col("text"), F.col("source")]).collect()
    words = Counter()
    for _, t, s in rows:
        words[s] += len(plain_words(t))
    want = plain_targets(dict(words))
    assert Counter((r.doc_id, r.text, r.source) for r in got) == Counter(rows)
    taken = Counter()
    for r in got:
        assert r["size"] == len(plain_words(r.text)) and r.source_size == words[r.source]
        rate = want[r.source] / words[r.source] if words[r.source] else 0
        assert int(rate) <= r.copies <= int(rate) + (rate != int(rate))
        taken[r.source] += r["size"] * r.copies
    for s, target in want.items():
        assert taken[s] == pytest.approx(float(target), rel=0.05)
    again = X.repetitions(df.repartition(13), [F.col("doc_id"), F.col("text"), F.col("source")]).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_the_mix_emits_every_copy(spark):
    df = docs(spark, mixed_rows()[:300])
    plan = Counter()
    for r in X.repetitions(df, [F.col("doc_id")]).collect():
        plan[r.doc_id] += r.copies
    mix = X.mixture(df)
    assert mix.columns == [*df.columns, "copy"]
    assert Counter(r.doc_id for r in mix.collect()) == +plan
    assert X.mixture(df.limit(0)).count() == 0
