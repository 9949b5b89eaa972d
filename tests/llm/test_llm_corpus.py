"""Operators across documents: decontamination, dedup, joins, search; and the pipeline."""

import collections
import hashlib
import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tripdemand.llm import decontamination as D
from tripdemand.llm import exact_topk as K
from tripdemand.llm import ngram_join as N
from tripdemand.llm import substring_chunks as B
from tripdemand.llm import suffix_dedup as S
from tripdemand.llm.components import components
from tripdemand.llm.text_arrays import RangeHash, flatten

CLASHING = "doc_id long, text string, _key int, item_id string, id int, rep int, a int, class_id int, lang string"


def docs(spark, pairs):
    return spark.createDataFrame([(i, t, 0, "x", 0, 0, 0, 0, "en") for i, t in pairs], CLASHING)


def prose(seed, words):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(words))


def shingles(text):
    w = re.findall("[a-z0-9\x80-\U0010ffff]+", (text or "").lower())
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def test_range_hashes_do_not_depend_on_place():
    data, _ = flatten(["xxabcabc", "abc"])
    other, _ = flatten(["abc"])
    assert RangeHash(data).of(np.array([2, 5, 8]), np.array([5, 8, 11])).tolist() == [RangeHash(other).of(np.array([0]), np.array([3]))[0]] * 3


def test_components_equal_union_find(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(1, 50)] + [(7, 7), (None, 3)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# decontamination --------------------------------------------------------------


def test_contaminated_documents(spark):
    items = [(1, prose(1, 30)), (2, prose(2, 12)), (3, "tiny item"), (4, None), (5, "!!"), (6, prose(1, 30))]
    w = items[0][1].split()
    texts = [
        (0, prose(10, 4000) + " " + items[0][1].upper() + ". " + prose(11, 4000)), (1, " ".join(w[:26])), (2, " ".join(w[:20])),
        (3, prose(12, 50)), (4, "here is a tiny, item!"), (5, "Tiny  item"), (6, None), (7, ""), (None, items[1][1]), (8, items[1][1]), (8, items[1][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.item_id, r.n_matched, r.n_shingles) for r in D.contaminated_documents(docs(spark, texts), bench).collect())
    want = []
    for d, t in texts:
        for i, x in items:
            s = shingles(x)
            both = len(s & shingles(t))
            if s and both >= 0.8 * len(s) - 1e-9:
                want.append((d if d is not None else -1, i, both, len(s)))
    assert got == sorted(want) and {g[0] for g in got} == {0, 1, 5, 8, -1}
    kept = D.without_contaminated(docs(spark, texts), bench)
    assert kept.columns == docs(spark, []).columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 6, 7]
    assert D.contaminated_documents(docs(spark, []), bench).collect() == []
    assert kept.count() == 5 and D.without_contaminated(docs(spark, texts), bench.limit(0)).count() == len(texts)


def test_decontamination_runs_no_python(spark):
    bench = spark.createDataFrame([(1, prose(1, 30))], "item_id long, text string")
    plan = D.contaminated_documents(docs(spark, [(0, prose(1, 40))]), bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# near duplicates --------------------------------------------------------------


def near_corpus():
    rng = random.Random(8)
    pairs, k = [], 0
    for g in range(25):
        base = prose(100 + g, rng.randint(20, 120)).split()
        for _ in range(rng.randint(1, 6)):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = "w%d" % rng.randrange(10**6)
            pairs.append((k, " ".join(own)))
            k += 1
    big = prose(999, 150).split()
    for _ in range(90):  # more than a block of 32
        own = list(big)
        own[rng.randrange(len(own))] = "v%d" % rng.randrange(10**6)
        pairs.append((k, " ".join(own)))
        k += 1
    pairs += [(k + i, t) for i, t in enumerate(["", None, "", "one two", "One, two!", "one two three", "!!", pairs[0][1], pairs[0][1]])]
    return pairs


def test_near_duplicates_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 32)
    pairs = near_corpus()
    sets = {i: shingles(t) for i, t in pairs}
    first = {}
    for i in sorted(sets):
        first.setdefault(sets[i], i)
    reps = [i for s, i in first.items() if s]
    links = collections.Counter()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in reps:
        for b in reps:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = {r.doc_id: (r.class_id, r.n_links) for r in N.near_duplicate_classes(docs(spark, [*pairs, (None, "one two")])).collect()}
    assert got == {i: (find(first[s]), links[first[s]]) if s else (i, 0) for i, s in sets.items()}
    kept = N.one_of_each_class(docs(spark, [*pairs, (None, "one two")]))
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(i for i, (c, _) in got.items() if i == c)
    assert kept.where("doc_id is null").count() == 1 and kept.columns == docs(spark, []).columns
    assert N.near_duplicate_classes(docs(spark, [])).collect() == []


def test_repeated_ids_have_a_defined_class(spark):
    a, b = prose(1, 40), prose(2, 40)
    rows = N.near_duplicate_classes(docs(spark, [(1, a), (1, b), (2, a), (3, b), (4, a), (4, a)])).collect()
    assert len(rows) == 6 and len({(r.doc_id, r.class_id) for r in rows}) == 4


def test_one_row_of_each_class_of_the_pipeline(spark):
    import corpus_pipeline

    a, b, c, d = (prose(k, 40) for k in range(1, 5))
    pairs = [(1, a), (1, a), (2, a), (None, a), (3, b), (3, c), (4, a), (4, d), (None, d), (None, "own words"), (None, "own words"), (5, "!!"), (5, "!!"), (6, None), (7, c + " more")]
    got = sorted((r.doc_id or 0, r.text or "") for r in corpus_pipeline.near_duplicates(spark, docs(spark, pairs), "").collect())
    assert got == sorted([(1, a), (3, b), (3, c), (4, d), (0, "own words"), (5, "!!"), (5, "!!"), (6, "")])
    assert corpus_pipeline.near_duplicates(spark, docs(spark, pairs), "").columns == docs(spark, []).columns


def test_pruning_keeps_what_can_reach_the_threshold():
    least = N.fewest_agreements(0.8, N.TOLERANCE)
    assert list(least) == sorted(least) and all(0 < m < 0.8 * N.STEP * (i + 1) for i, m in enumerate(least))


# repeated bytes ---------------------------------------------------------------


def byte_corpus():
    passage, other = prose(50, 70), prose(51, 60)
    return [
        (0, prose(1, 80) + passage + prose(2, 60)), (1, prose(3, 50) + passage + prose(4, 10)), (2, passage), (3, prose(5, 100)), (4, prose(5, 100)),
        (5, ""), (6, None), (7, "short"), (8, "short"), (9, "a" * 1000), (10, "é" * 300 + other), (11, other[3:] + "日" * 90), (12, "ab" * 400), (None, prose(6, 90)), (None, prose(6, 90)), (14, prose(7, 3000)), (3, prose(5, 100)),
    ]


@pytest.mark.parametrize("spans_per_anchor", [20_000, 1])
def test_suffix_dedup_equals_counting_windows(spark, spans_per_anchor):
    rows = byte_corpus()
    data = [(i, (t or "").encode()) for i, t in rows]
    count = collections.Counter(b[k : k + 200] for _, b in data for k in range(len(b) - 199))
    want = []
    for i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - 199):
            if count[b[k : k + 200]] > 1:
                gone[k : k + 200] = b"\1" * 200
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        runs = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        want.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest(), kept))
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in S.remove_repeated(docs(spark, rows), with_kept=True, spans_per_anchor=spans_per_anchor).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(got, key=key) == sorted(want, key=key)
    assert S.remove_repeated(docs(spark, [])).collect() == []


def test_suffix_arrays_are_sorted():
    rng = random.Random(3)
    for _ in range(40):
        length = rng.choice([16, 24, 40])
        alphabet = rng.choice(["ab", "abcd", "a", "abcdefghijklmnopqrstuvwxyz"])
        base = ["".join(rng.choice(alphabet) for _ in range(rng.randint(length, 90))).encode() for _ in range(4)]
        spans = [s for s in (rng.choice(base)[rng.randint(0, 9) :] + bytes(rng.randint(0, 9)) for _ in range(12)) if len(s) >= length]
        windows = [len(s) - length + 1 for s in spans]
        count = collections.Counter(s[i : i + length] for s, n in zip(spans, windows, strict=True) for i in range(n))
        for s, n, got in zip(spans, windows, S.repeated_windows(spans, windows, length) if spans else [], strict=True):
            assert got.tolist() == [i for i in range(n) if count[s[i : i + length]] > 1]
        if spans:
            sym = np.frombuffer(b"\xff".join([*spans, b""]), np.uint8) + np.uint8(1)
            ends = np.cumsum([len(s) + 1 for s in spans])
            rest = np.repeat(ends - 1, [len(s) + 1 for s in spans]) - np.arange(len(sym))
            order = S.suffix_array(sym, S.next_words(sym, rest), rest, length)
            keys = [sym[i : i + min(rest[i], length)].tobytes() for i in order]
            assert sorted(order.tolist()) == list(range(len(sym))) and keys == sorted(keys)


def naive_cuts(b):
    """Chunk starts of one document by the definition."""
    table = np.random.default_rng(B.SEED).integers(0, 2**32, 256, dtype=np.uint32)
    h, hashes = 0, []
    for x in b:
        h = ((h << 1) + int(table[x])) % 2**32
        hashes.append(h)
    first = B.REACH + B.GEAR_BITS
    low = [first <= i < len(b) - B.REACH and hashes[i] == min(hashes[i - B.REACH : i + B.REACH + 1]) for i in range(len(b))]
    if not b:
        return []
    out = [0]
    for i in range(1, len(b)):
        if low[i] and not low[i - 1]:
            out.append(i)
    full = []
    for s, e in zip(out, [*out[1:], len(b)], strict=True):
        full += range(s, e, B.LONGEST)
    return full


def test_chunks_equal_the_definition():
    texts = [prose(1, 300), "", "a" * 1500, "the " * 200, prose(2, 3), "é" * 500]
    data, starts = flatten(texts)
    got = B.cuts(data, starts)
    assert got.tolist() == [int(s) + c for s, t in zip(starts, texts, strict=False) for c in naive_cuts(t.encode())]


def test_repeated_passages(spark):
    rows = byte_corpus()
    chunk = collections.defaultdict(set)
    own = {}
    for i, t in {(i, t) for i, t in rows if i is not None and t}:
        b = t.encode()
        at = naive_cuts(b)
        own.setdefault(i, []).extend((s, e, b[s:e]) for s, e in zip(at, [*at[1:], len(b)], strict=True))
        for s, e in zip(at, [*at[1:], len(b)], strict=True):
            chunk[b[s:e]].add((i, s))
    want = {}
    for i, parts in own.items():
        runs = []
        for s, e, c in sorted(p for p in parts if len(chunk[p[2]]) > 1):
            gone = (e - s) * ((i, s) != min(chunk[c]))
            if runs and runs[-1][1] == s:
                runs[-1] = (runs[-1][0], e, runs[-1][2] + gone)
            else:
                runs.append((s, e, gone))
        runs = [r for r in runs if r[1] - r[0] >= B.LEAST_RUN]
        if runs:
            want[i] = (len(runs), sum(e - s for s, e, _ in runs), sum(g for *_, g in runs), ",".join(f"{s}:{e}" for s, e, _ in runs))
    got = {r.doc_id: (r.n_passages, r.n_repeated, r.n_removed, r.passages) for r in B.repeated_documents(docs(spark, rows)).collect()}
    assert got == want and {0, 1, 2, 3, 4} <= set(got) and not {7, 8, 14} & set(got)
    assert B.repeated_documents(docs(spark, [])).collect() == []


def test_copies_of_short_documents(spark, tmp_path):
    from tripdemand.llm import queries

    two = next(t for t in (prose(k, 14)[:95] for k in range(200)) if len(naive_cuts(t.encode())) == 2)
    cut = naive_cuts(two.encode())[1]
    rows = [(1, "short"), (2, "short"), (2, "short"), (3, two), (4, two), (5, "alone"), (6, two[:cut] + "é" * 9), (7, prose(9, 80)), (8, prose(9, 80)), (9, ""), (10, None), (None, "short")]
    docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.n_passages, r.n_repeated, r.n_removed, r.passages) for r in queries.QUERIES["op5_substring_dedup"](spark, str(tmp_path)).collect()}
    assert got.pop(7)[2] == 0 and got.pop(8)[2] >= B.LEAST_RUN
    assert got == {1: (1, 5, 0, "0:5"), 2: (1, 5, 5, "0:5"), 3: (1, len(two), 0, f"0:{len(two)}"), 4: (1, len(two), len(two), f"0:{len(two)}")}


# search -----------------------------------------------------------------------


def naive_topk(rows, k):
    ints = [(i, [int(np.floor(256.0 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for r, (q, u) in enumerate(ints):
        if q % 5 == 0:
            best = sorted((-sum(a * b for a, b in zip(u, v, strict=False)), i) for o, (i, v) in enumerate(ints) if o != r)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [(8192, 512), (7, 3)])
def test_topk_equals_brute_force(spark, sizes):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=9)]) for i in range(60)]
    rows += [(60 + i, [0.5] * 9) for i in range(30)] + [(90, None), (91, []), (92, [1.0, None]), (93, [float("nan")] * 9), (94, [float("inf")] * 9), (None, [9.0] * 9), (95, [1.0, 2.0]), (3, rows[3][1]), (5, rows[5][1]), (10, [1.0] * 9), (7, [0.0] * 9), (96, [-3.0] * 9), (100, [4000.0] * 9)]
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, score int, block int")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in K.exact_topk(table, F.col("vec_id") % 5 == 0, vectors_per_block=sizes[0], queries_per_block=sizes[1]).collect())
    assert got == naive_topk(rows, 5)


def test_topk_with_few_or_no_candidates(spark):
    table = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in K.exact_topk(table, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 256 * 512)]
    assert K.exact_topk(table.where("vec_id = 0"), F.lit(True)).collect() == []
    assert K.exact_topk(table.limit(0), F.lit(True)).collect() == []


def test_topk_of_empty_vectors_and_numbers_beyond_a_long(spark):
    vectors = lambda *rows: spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    of_first = lambda t: [(r.vec_id, r.score) for r in K.exact_topk(t, F.col("vec_id") == 0).collect()]
    assert of_first(vectors([], [])) == [(1, 0)]
    assert of_first(vectors([-1.0], [], [1.0])) == [(1, 0), (2, -(256**2))]
    # parts beyond a long whose sum fits: exact
    big = [2.0**40, 2.0**40, 1.0]
    assert of_first(vectors(big, [2.0**40, -(2.0**40), 3.0], [0.0, 0.0, 1.0])) == [(1, 3 * 256**2), (2, 256**2)]
    with pytest.raises(Exception, match="a score does not fit a long"):
        of_first(vectors(big, big))
    with pytest.raises(Exception, match="a component does not fit a long"):
        of_first(vectors([1.0], [1e300]))


# pipeline ---------------------------------------------------------------------


def test_pipeline_stage_by_stage(spark, tmp_path):
    import corpus_pipeline

    public = pytest.importorskip("public_tokenizers")
    import sentencepiece

    sf = "/root/testdata/sf0.001"
    kept = spark.read.parquet(f"{sf}/documents.parquet")
    columns = kept.columns
    before = {r.doc_id: r.text for r in kept.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, kept, sf)
        path = os.path.join(tmp_path, name)
        out.write.parquet(path)
        kept = spark.read.parquet(path)
        rows = {r.doc_id: r for r in kept.collect()}
        if name != "token_ids":
            assert kept.columns == columns
        if name == "language_id":
            want = {i for i, t in before.items() if any(c.isalpha() for c in t or "")}
        elif name == "near_duplicates":
            classes = {}
            for i in sorted(before):
                s = shingles(before[i])
                classes.setdefault(next((j for j in sorted(classes) if len(s & shingles(before[j])) >= 0.8 * len(s | shingles(before[j]))), i), []).append(i)
            want = set(classes)
        elif name == "decontamination":
            items = [shingles(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            want = {i for i, t in before.items() if not any(x and len(x & shingles(t)) >= 0.8 * len(x) for x in items)}
        else:
            want = set(before)
        assert set(rows) == want, name
        if name == "secrets":
            from tripdemand.llm import secret_scan

            assert all(r.text == secret_scan.redacted(before[i], secret_scan.find_secrets(before[i]), "[secret]") and r.n_chars == len(r.text) for i, r in rows.items())
        if name == "token_ids":
            lib = sentencepiece.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))
            assert all(list(rows[i].ids) == lib.encode(t, add_eos=True) for i, t in before.items())
        else:
            before = {i: r.text for i, r in rows.items()}
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, sf).select("doc_id").collect()) == sorted(rows)


def test_stages_send_small_batches_to_python(spark):
    import corpus_pipeline

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    long_texts = spark.range(0, 4000, 1, 1).select(F.repeat(F.lit("ab cd ef"), 500).alias("t"))
    for stage in (corpus_pipeline.language_id, corpus_pipeline.near_duplicates, corpus_pipeline.secrets, corpus_pipeline.token_ids):
        spark.conf.unset(key)
        try:
            stage(spark, docs(spark, [(1, "one two three four five six"), (2, "seven")]), "")
            seen = [r.n for r in long_texts.mapInArrow(sizes, "n long").collect()]
            assert sum(seen) > 16_000_000 and max(seen) < 5_000_000
            spark.conf.set(key, "1000000")
            stage(spark, docs(spark, [(1, "one two three four five six"), (2, "seven")]), "")
            assert spark.conf.get(key) == "1000000"
        finally:
            spark.conf.unset(key)


def test_pipeline_of_no_rows(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    out = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, sf)
    assert out.collect() == []


def test_pipeline_stages_keep_clashing_columns(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    clashing = ("score", "lang_pred", "_text", "_node", "_row", "_node0", "row", "id", "k1", "_key", "spans", "odd name")
    given = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 60").withColumns({c: F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")) for c in clashing})
    out = given
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, sf)
        assert out.columns == given.columns, name
        rows = out.collect()
        assert rows and all(r[c] == f"{c}-{r.doc_id}" for r in rows for c in clashing), name
        out = spark.createDataFrame(rows, out.schema)
    assert corpus_pipeline.STAGES[-1][1](spark, out, sf).count() == len(rows)


def test_queries_against_their_oracles(spark):
    import duckdb

    from tripdemand.llm import queries

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    for name, sql in queries.ORACLE.items():
        got, want = queries.QUERIES[name](spark, sf), con.sql(sql)
        assert sorted(got.columns) == sorted(want.columns)
        rows = want.select(", ".join(f'"{c}"' for c in got.columns)).fetchall()
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(rows, key=repr), name
