"""The n-gram join on shared passages, the quality verdict and the pipeline, against brute force."""

import collections
import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from statwright.llm import ngram_jaccard, quality
from statwright.llm import queries as Q

from test_corpus_operators import ALNUM, BLANK, SCHEMA, components, corpus, hits, low


def test_parities_never_turn_a_link_down():
    rng = np.random.default_rng(4)
    sim = ngram_jaccard.Similarity(4, 5)
    turned = 0
    for size in (1, 5, 63, 64, 65, 120, 128, 700, 5000):
        pool = np.unique(rng.integers(0, 1 << 63, 2 * size, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
        a = np.sort(rng.permutation(pool)[:size])
        for gone in (0, 1, size // 20, size // 9, size // 5, size // 2, size):
            b = np.sort(np.concatenate([rng.permutation(a)[gone:], rng.integers(0, 1 << 63, gone // 2, dtype=np.uint64)]))
            both = len(np.intersect1d(a, b))
            linked = 5 * both >= 4 * (len(a) + len(b) - both) and len(b) > 0
            ok = ngram_jaccard.may_link(ngram_jaccard.parity(a), ngram_jaccard.parity(b)[None, :], len(a), np.array([len(b)]), sim)[0]
            assert ok or not linked
            turned += not ok
    assert turned >= 15
    assert ngram_jaccard.parity(np.zeros(0, np.uint64)).sum() == 0


def passages(seed=8):
    """Families of near copies that all hold the same passages, so that lists mix families; some are short."""
    rng = random.Random(seed)
    shared = [" ".join(f"s{rng.randrange(400)}" for _ in range(60)) for _ in range(3)]
    rows = []
    for family in range(12):
        size = 90 if family % 4 else 9
        base = [f"w{rng.randrange(500)}" for _ in range(size)]
        for _ in range(6):
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(size)] = f"w{rng.randrange(500)}"
            own[rng.randrange(size):0] = rng.choice(shared).split() if size > 9 else []
            rows.append(" ".join(own))
    rows += [rows[0], None, "", "a b"]
    rng.shuffle(rows)
    return [(i, t, None, None, 7, "clash", "clash") for i, t in enumerate(rows)]


@pytest.mark.parametrize("n,num,den", [(3, 9, 10), (5, 4, 5), (2, 1, 2)])
def test_families_with_shared_passages(spark, n, num, den):
    rows = passages()
    got = ngram_jaccard.ngram_components(spark.createDataFrame(rows, SCHEMA).repartition(4), n, (num, den))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == components(rows, n, num, den)


def test_members_of_a_centre_meet(spark):
    """Links between members that are far from their centre, found in one task."""
    rng = random.Random(1)
    sim = ngram_jaccard.Similarity(4, 5)
    made = {0: set(range(100))}
    for i in range(1, 9):
        made[i] = {10_000 * (i % 3) + k for k in range(150)} ^ {rng.randrange(10_000 * (i % 3), 10_000 * (i % 3) + 150) for _ in range(6)}
    import pyarrow as pa
    mixed = {i: np.sort(ngram_jaccard.W.mix(np.array(sorted(s), dtype=np.uint64) + np.uint64(1)).view(np.int64)) for i, s in made.items()}
    ids = list(range(1, 9))
    held = [pa.RecordBatch.from_arrays(
        [pa.array([0] * 8), pa.array(ids), pa.array(ids), pa.array([True] * 8), pa.array([mixed[i] for i in ids], pa.list_(pa.int64()))],
        names=["centre", "member", "root", "far", "items"])]
    links = ngram_jaccard.group_links(sim, held).to_pydict()
    joined = {i: {i} for i in ids}
    for a, b in zip(links["a"], links["b"], strict=True):
        assert 5 * len(made[a] & made[b]) >= 4 * len(made[a] | made[b])
        both = joined[a] | joined[b]
        for k in both:
            joined[k] = both
    assert {frozenset(x) for x in joined.values()} == {frozenset(i for i in ids if i % 3 == r) for r in range(3)}


def verdicts(rows, min_group=quality.MIN_GROUP):
    """doc_id of the documents inside the thresholds of their group."""
    seen, groups = {}, collections.defaultdict(lambda: collections.defaultdict(list))
    for d, t, lang, source, *_ in rows:
        t = t or ""
        w = BLANK.findall(t)
        lines = [x for x in t.split("\n") if BLANK.search(x)]
        runs = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        again = len({k for i in range(len(w) - 2) if runs[tuple(w[i:i + 3])] > 1 for k in (i, i + 1, i + 2)})
        chars, symbols = sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>")
        value = {"symbols": 1000 * symbols // max(chars, 1), "dup_lines": 1000 * (len(lines) - len(set(lines))) // max(len(lines), 1),
                 "repeats": 1000 * again // max(len(w), 1), "word_length": 100 * chars // max(len(w), 1)}
        seen[d] = (lang, source, value, len(w) < 50 or 100 * again > 50 * len(w))
        for name, v in value.items():
            cut = v >> max(0, v.bit_length() - 11) << max(0, v.bit_length() - 11)
            for key in ((lang, source), (lang,), ()):
                groups[key][name].append(cut)
    kept = set()
    for d, (lang, source, value, failed) in seen.items():
        inside = True
        for r in quality.RULES:
            key = next(k for k in ((lang, source), (lang,), ()) if not k or len(groups[k][r.name]) >= min_group)
            s = sorted(groups[key][r.name])
            q1, q3 = s[-(-len(s) // 4) - 1], s[-(-3 * len(s) // 4) - 1]
            reach = max(r.ranges * (q3 - q1), r.least)
            inside &= (q1 - reach if r.both else 0) <= value[r.name] <= q3 + reach
        if inside and not failed:
            kept.add(d)
    return kept


def spoilt(n, seed):
    """The corpus with some documents full of symbols, repeated lines or long words."""
    rng, out = random.Random(seed), []
    for d, t, lang, source, *rest in corpus(n, seed):
        if t and d > 6 and d % 19 == 0:
            w = t.split()
            t = rng.choice([" ".join(x + "#*" for x in w), "\n".join([t, t]), " ".join(x * 9 for x in w), "\n".join(["same line here"] * 9 + w)])
        out.append((d, t, lang, source if d % 3 else "a", *rest))
    return out


@pytest.mark.parametrize("n", [80, 900])
def test_quality_verdict(spark, n):
    rows = spoilt(n, 5)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = verdicts(rows)
    measured = quality.measure(docs)
    got = quality.judge(measured, quality.thresholds(measured))
    assert {r.doc_id for r in got.filter("kept").collect()} == want
    assert {r.doc_id for r in quality.quality_filter(docs).collect()} == want and 0 < len(want) < len(rows)


def test_pipeline_stage_by_stage(spark, tmp_path):
    from tokenizers import Tokenizer
    rows = spoilt(150, 6)
    items = [(1, rows[40][1]), (2, " ".join((rows[9][1] or "").split()[20:34])), (3, None), (4, "not in there")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, after = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        after[name] = [tuple(r) for r in docs.collect()]
        if name != "token_files":
            assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    good = [r for r in rows if r[0] in verdicts(rows)]
    assert sorted(after["quality_rules"]) == sorted(good, key=lambda r: r[0])
    single = [r for r in good if components(good, 5, 4, 5)[r[0]][1] == r[0]]
    assert sorted(after["near_duplicates"]) == single
    clean = {}
    found = hits(single, items, 10)
    for d, t, *_ in single:
        n, h, _ = found[d]
        if 2 * h <= n:
            clean[d] = t
    left = {r[0]: r[1] for r in after["benchmark_decontamination"]}
    assert set(left) == set(clean)
    for d, t in left.items():
        n, h, _ = found[d]
        assert t == clean[d] if not h else len(ALNUM.findall(low(t))) == n - h
    assert not any(h for _, h, _ in hits([(d, t) for d, t in left.items()], items, 10).values())
    taken = collections.Counter(r[0] for r in after["source_mix"])
    assert set(taken) <= set(left) and max(taken.values()) <= 3 and all(r[1] == left[r[0]] for r in after["source_mix"])
    tok = Tokenizer.from_file(Q.tokenizer_path())
    want = collections.Counter()
    for d, copies in taken.items():
        ids = tok.encode(left[d] or "", add_special_tokens=False).ids + [1]
        want[d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += copies
    assert collections.Counter((r[0], r[2], r[3]) for r in after["token_files"]) == want
