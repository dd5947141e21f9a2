"""Operators against brute force on small texts with odd cases."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from statwright.llm import (backoff_lm, decontamination, licences, mixing, ngram_jaccard, pseudonyms, quality,
                            token_codes, toxicity, url_rules)
from statwright.llm import queries as Q

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_words long, size string, items string"


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def corpus(n=60, seed=3):
    rng = random.Random(seed)
    words = [f"Wort{i}" for i in range(80)] + ["é", "x　y", "A,b"]
    texts = [None, "", " \t\n", "one", "two words", "long " * 3000]
    base = [rng.choice(words) for _ in range(90)]
    for i in range(n):
        own = list(base) if i % 3 == 0 else [rng.choice(words) for _ in range(rng.randint(1, 160))]
        for _ in range(rng.randint(0, 5)):
            own[rng.randrange(len(own))] = rng.choice(words)
        texts.append(rng.choice([" ", "\n"]).join(own))
    texts += [texts[9], texts[9]]
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["a", "b", None]), 7, "clash", "clash") for i, t in enumerate(texts)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3).persist()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def components(rows, n, num, den):
    made = {}
    for d, t, *_ in rows:
        w = BLANK.findall(low(t))
        made[d] = {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()
    root = {d: d for d in made}

    def top(d):
        while root[d] != d:
            d = root[d]
        return d
    for a in made:
        for b in made:
            if a < b and made[a] and den * len(made[a] & made[b]) >= num * len(made[a] | made[b]):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {d: (len(made[d]), top(d)) for d in made}


@pytest.mark.parametrize("n,num,den", [(3, 9, 10), (5, 4, 5)])
def test_components_are_exact(docs, n, num, den):
    want = components(corpus(), n, num, den)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard.ngram_components(docs, n, (num, den)).collect()}
    assert got == want


def test_wide_lists_are_joined_the_same(docs, monkeypatch):
    monkeypatch.setattr(ngram_jaccard.beyond_centres, "__defaults__", (0,))
    want = components(corpus(), 3, 9, 10)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard.ngram_components(docs, 3, (9, 10)).collect()}
    assert got == want


def test_duplicates_leave_one_of_each_group(docs, none):
    want = {d for d, (_, c) in components(corpus(), 5, 4, 5).items() if d == c}
    kept = ngram_jaccard.deduplicate(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(want)
    assert ngram_jaccard.deduplicate(none).count() == 0


def hits(rows, items, window):
    runs = collections.defaultdict(set)
    for i, t in items:
        w = ALNUM.findall(low(t))
        for k in range(max(1, len(w) - window + 1)) if w else []:
            runs[tuple(w[k:k + window])].add(i)
    out = {}
    for d, t, *_ in rows:
        w, hit, met = ALNUM.findall(low(t)), set(), set()
        for n in {len(r) for r in runs}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in runs:
                    hit |= set(range(k, k + n))
                    met |= runs[tuple(w[k:k + n])]
        out[d] = (len(w), len(hit), sorted(met))
    return out


@pytest.mark.parametrize("max_words", [10_000, 40])
def test_decontamination_finds_every_window(spark, docs, none, max_words):
    texts = [t for _, t, *_ in corpus()]
    items = [(1, texts[12]), (2, " ".join((texts[20] or "").split()[:12])), (3, "two words"), (4, None), (5, "nowhere at all to be found")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, sorted(r["items"])) for r in decontamination.hits(docs, bench, 10, max_words).collect()}
    assert got == hits(corpus(), items, 10)
    clean = decontamination.decontaminate(docs, bench, 10, 0.5, max_words)
    assert clean.columns == docs.columns
    again = decontamination.hits(clean, bench, 10, max_words)
    left = {r.doc_id for r in clean.collect()}
    assert left == {d for d, (n, h, _) in got.items() if h <= 0.5 * n}
    assert again.filter("n_hit > 0").count() == 0
    assert decontamination.decontaminate(none, bench).count() == 0
    assert decontamination.hits(docs, bench.limit(0)).filter("n_hit > 0").count() == 0


def test_one_word_items_stay_inside_their_documents(spark):
    rows = [(i, t) for i, t in enumerate(["x alpha beta", "gamma delta y", "alpha", "beta", "gamma", None, "alpha", "", "beta gamma delta", "gamma"])]
    items = [(1, "gamma"), (2, "alpha beta gamma delta"), (3, "beta alpha")]
    one = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {r.doc_id: r for r in decontamination.hits(one, bench, 3).collect()}
    assert {d: (r.n_words, r.n_hit, sorted(r["items"])) for d, r in found.items()} == hits(rows, items, 3)
    apart = {r.doc_id: r for r in decontamination.hits(one.repartition(len(rows), "doc_id"), bench, 3).collect()}
    assert apart == found and found[1].spans == [(0, 5)]


def test_token_files_round_trip(spark, docs, none, tmp_path):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(Q.tokenizer_path())
    token_codes.write(docs, f"{tmp_path}/t", Q.tokenizer_path())
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_codes.read(spark, f"{tmp_path}/t").collect()}
    start, every = 0, []
    for d, t, *_ in corpus():
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        assert got[d] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
        every += ids
    wanted = spark.createDataFrame([(p,) for p in range(0, start, 997)], "position long")
    assert {r.position: r.token for r in token_codes.lookup(spark, f"{tmp_path}/t", wanted).collect()} == {p: every[p] for p in range(0, start, 997)}
    token_codes.write(none, f"{tmp_path}/e", Q.tokenizer_path())
    assert token_codes.read(spark, f"{tmp_path}/e").count() == 0


def test_codes_give_random_access():
    rng = np.random.default_rng(1)
    ids = np.concatenate([rng.integers(0, 300, 5000), rng.integers(0, 1 << 31, 700), np.zeros(3, int)]).astype(np.uint32)
    levels, marks, ranks = token_codes.pack(ids)
    at = rng.permutation(len(ids))[:2000]
    assert (token_codes.fetch(levels, marks, ranks, at) == ids[at]).all() and (token_codes.unpack(levels, marks) == ids).all()


def test_quality_measures_and_thresholds(docs, none):
    rows = quality.measure(docs).collect()
    for r in rows:
        t = r.text or ""
        w = BLANK.findall(t)
        lines = [x for x in t.split("\n") if BLANK.search(x)]
        runs = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        again = {k for i in range(len(w) - 2) if runs[tuple(w[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_lines, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines), len(lines) - len(set(lines)), len(again))
    kept = quality.quality_filter(docs)
    assert kept.columns == docs.columns and {r.n_words for r in kept.collect()} <= {7}
    assert quality.quality_filter(none).count() == 0


def test_sketches_give_exact_quartiles(spark):
    rows = [("en", "a", i) for i in range(1, 101)]
    df = spark.createDataFrame(rows, "lang string, source string, v long")
    rule = (quality.Rule("v", "v", 1.0, 0, True),)
    q = quality.quartiles(quality.sketches(df, rule), ["lang", "source"]).first()
    assert (q.q1, q.q3, q.docs) == (25, 75, 100)
    big = spark.createDataFrame([(5_000_001,), (2047,)], "v long").select(quality.binned(F.col("v")).alias("b")).collect()
    assert big[1].b == 2047 and abs(big[0].b - 5_000_001) <= 5_000_001 / 1000


def test_mix_meets_targets(spark, docs, none):
    rng = random.Random(4)
    rows = [(i, s, rng.randint(0, 400)) for i in range(900) for s in ["a" if i % 3 else rng.choice(["b", "c", None])]]
    rows += [(5000 + i, "tiny", 30) for i in range(6)] + [(1, "a", 10), (1, "a", 10), (None, "b", 50)]
    sizes = spark.createDataFrame(rows, "doc_id long, source string, size long")
    out = mixing.mix(sizes, block=64).collect()
    again = mixing.mix(sizes.repartition(7), block=64).collect()
    assert sorted(map(str, out)) == sorted(map(str, again)) and len(out) == len(rows)
    total = collections.defaultdict(int)
    for r in out:
        total[r.source] += r.taken
        assert r.taken <= 3 * r.size
    names = sorted({s for _, s, _ in rows if s}) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    size = {s: sum(z for _, x, z in rows if x == s) for s in names}
    goal, free, all_words = {}, set(names), sum(size.values())
    while True:
        rate = (all_words - sum(goal.values())) / sum(weight[s] for s in free)
        over = {s for s in free if rate * weight[s] > 3 * size[s]}
        if not over:
            break
        goal |= {s: 3.0 * size[s] for s in over}
        free -= over
    goal |= {s: rate * weight[s] for s in free}
    for r in out:
        assert math.isclose(r.target, goal[r.source], rel_tol=1e-9)
    for s in names:
        assert abs(total[s] - goal[s]) <= 0.01 * goal[s] + 30
    assert mixing.mixed(none).count() == 0 and mixing.mixed(docs).columns == docs.columns


def test_language_model(docs, none):
    train = docs.filter("doc_id % 5 <> 0")
    model, single = backoff_lm.train(train)
    one = {r.doc_id: r for r in backoff_lm.score(docs, model, single).collect()}
    two = {r.doc_id: r for r in backoff_lm.score(docs, model, single, shard_words=20).collect()}
    seqs = {d: [*BLANK.findall(low(t)), "\0end"] for d, t, *_ in corpus()}
    c, pair, n = collections.Counter(), collections.Counter(), 0
    for d, w in seqs.items():
        if d % 5:
            c.update(w)
            pair.update(zip(["\0begin", *w], w, strict=False))
            n += len(w)
    history = c + collections.Counter({"\0begin": sum(d % 5 > 0 for d in seqs)})
    able = {k: v for k, v in pair.items() if history[k[0]] >= 2 and c[k[1]] >= 2}
    n1, n2 = (sum(v == k for v in able.values()) for k in (1, 2))
    discount, kept = n1 / (n1 + 2 * n2), {k: v for k, v in pair.items() if v >= 2}
    held = collections.Counter()
    for (v, _), k in kept.items():
        held[v] += (k - discount) / history[v]
    for d, w in seqs.items():
        root = [(c[x] + 1) / (n + len(c) + 1) for x in w]
        score = 0.0
        for v, x, p in zip(["\0begin", *w], w, root, strict=False):
            arc = kept.get((v, x))
            score += math.log10(((arc - discount) / history[v] if arc else 0) + (1 - held[v]) * p)
        r = one[d]
        assert (r.n_tokens, r.n_known) == (len(w), sum(c[x] > 0 for x in w))
        assert math.isclose(r.base_score, sum(map(math.log10, root)), rel_tol=1e-9) and math.isclose(r.score, score, rel_tol=1e-6)
        assert math.isclose(two[d].score, r.score, rel_tol=1e-9) and two[d].n_known == r.n_known
    assert backoff_lm.score(none, model, single).count() == 0
    empty, counts = backoff_lm.train(none)
    assert backoff_lm.score(docs, empty, counts).filter("n_known > 0").count() == 0


def test_every_bigram_seen_twice_is_learned_at_any_size(spark):
    texts, many = ["x y", "x y", "once"], 5_000_000
    df = spark.createDataFrame(list(enumerate([*texts, "z " * many])), "doc_id long, text string").repartition(2)
    model, entries = backoff_lm.train(df)
    c = {"x": 2, "y": 2, "once": 1, "z": many, "\0end": 4}
    pair = {("\0begin", "x"): 2, ("x", "y"): 2, ("y", "\0end"): 2, ("z", "z"): many - 1}
    # Seen once with two words seen twice: begin z and z end.
    discount, size = 2 / (2 + 2 * 3), sum(c.values()) + len(c) + 1
    assert (model.tokens, model.distinct) == (sum(c.values()), len(c))
    got = {r.doc_id: r for r in backoff_lm.score(df.filter(F.length("text") < 9), model, entries).collect()}
    for d, t in enumerate(texts):
        w, want = [*t.split(), "\0end"], 0.0
        for v, x in zip(["\0begin", *w], w, strict=False):
            of = {**c, "\0begin": 4}[v]
            held = sum((k - discount) / of for (h, _), k in pair.items() if h == v)
            want += math.log10(((pair[v, x] - discount) / of if (v, x) in pair else 0) + (1 - held) * (c[x] + 1) / size)
        assert math.isclose(got[d].score, want, rel_tol=1e-9) and got[d].n_known == len(w)


def test_levenshtein_trie_matches_edit_distance():
    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            prev, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(prev[j] + 1, row[-1] + 1, prev[j - 1] + (x != y)))
        return row[-1]
    terms, rng = ["abcab", "bcabca", "abc", "cabcc*"], random.Random(2)
    machine = toxicity.Machine(terms)
    for _ in range(4000):
        w = "".join(rng.choice("abc") for _ in range(rng.randint(0, 8)))
        exact = w in ("abcab", "bcabca", "abc") or w.startswith("cabcc")
        near = any(edits(w, t) <= 1 for t in ("abcab", "bcabca"))
        assert machine.match(w) == (1 if exact else 2 if near else 0), w


def test_toxicity_on_held_out_rows(spark, none):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        w = [rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(40)]
        bad = i % 6 == 0
        if bad:
            w[rng.randrange(40)] = rng.choice(["dolty", "blegfoo", "blegbar", f"bleg{chr(97 + i % 26)}{chr(97 + i // 26)}"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    rows.append((700, "alpha d0lty beta"))
    rows += [(701, None), (702, "")]
    df, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    out = {r.doc_id: r for r in toxicity.score(df, lab, "doc_id % 4 = 0").collect()}
    held = [i for i in range(600) if i % 4 == 0]
    assert sum(out[i].predicted == int(i % 6 == 0) for i in held) >= 0.97 * len(held)
    assert out[701].score == out[702].score and out[701].predicted == 0 and out[700].n_misspelt + out[700].n_direct == 1
    assert all(0 <= r.score <= 1 for r in out.values())
    assert toxicity.score(none, lab).count() == 0
    assert toxicity.score(df, lab.limit(0)).filter("predicted = 1").count() == 0


def test_misspelt_words_of_a_stem_are_found(spark):
    rows = [(i, f"alpha beta {('stupid', 'stupidity')[i // 6 % 2] if i % 6 == 0 else 'gamma'} delta") for i in range(240)]
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i, _ in rows], "doc_id long, toxic int")
    rows += [(900, "alpha stpid beta"), (901, "alpha stupidness beta"), (902, "alpha sutpidness beta"), (903, "alpha stxpidity beta")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    terms = toxicity.learn_terms(toxicity.labelled(df, labels))
    assert {"stup*", "stupid", "stupidity"} == set(terms)
    out = {r.doc_id: (r.n_direct, r.n_misspelt) for r in toxicity.score(df, labels).collect()}
    assert [out[i] for i in (0, 6, 900, 901, 902, 903)] == [(1, 0), (1, 0), (0, 1), (1, 0), (0, 0), (0, 1)]


def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://A.Example.com/en/1", "https://www.example.com/en/x?q=/fr/", "http://x.net/es/", "http://x.net/fr",
            "http://example.com", "ftp://notexample.com/en/", "http://com/", "http://b.net/fr/9#top", "http://spam.org/buy/3"]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge(pages, Q.URL_RULES).collect()}
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = low(re.match(r"[^/?#]*", rest)[0])
        path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
        fit = [r for r in Q.URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fit, key=lambda r: len(r.host + r.path), default=None)
        assert got[i] == (host, path, best and best.host + best.path, best.verdict if best else "allow")
    seen = [(f"http://site{i}.org/{'buy' if i % 4 == 0 else 'news'}/{i}", i % 4 == 0) for i in range(200)]
    labelled = spark.createDataFrame(seen, "url string, blocked boolean")
    verdict = {r.page_id: r.verdict for r in url_rules.judge(pages, Q.URL_RULES, labelled).collect()}
    assert verdict[11] == "block" and verdict[2] == "allow"


def test_licences_match_brute_force(spark, none):
    texts = [None, "", "MIT", "x\nReleased under the MIT license!\ny", "Released under a MIT License", "all rights RESERVED", "No rights reserved here",
             licences.TEMPLATES["GPL-3.0 notice"].replace(" and/or", "\nand/or"), "Licensed under CC BY-NC 4.0. More words follow in this very line today"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def grams(t):
        w = re.findall(r"[^\W_]+", t.lower())
        return set(zip(w, w[1:], strict=False))
    for r in licences.scan(df).collect():
        t = texts[r.doc_id] or ""
        best = max(((2 * len(grams(p) & grams(x)) / max(1, len(grams(p)) + len(grams(x))), name)
                    for p in [*t.split("\n"), t] for name, x in licences.TEMPLATES.items()), default=(0, None))
        assert (r.dice is None) == (best[0] < 0.8) and (r.dice is None or math.isclose(r.dice, best[0]))
    assert licences.scan(none).count() == 0


def test_pseudonyms_are_permutations_in_format(spark, none):
    assert spark.range(146_097).select(pseudonyms.permuted_number(F.col("id"), 189, 773, "k").alias("p")).select(
        F.countDistinct("p"), F.max("p")).first() == (146_097, 146_096)
    texts = ["pay 4111 1111 1111 1111 or 4111111111111111, not 4111111111111112", "on 2024-02-29, never 2023-02-30; a.b9@x.org (555)",
             "10.0.0.255 and 300.1.1.1 call +1 (555) 123-4567 now", None, "", "nothing"]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, found string")
    out = {r.doc_id: r for r in pseudonyms.mask(df, "k").collect()}
    assert [f.kind for f in out[0].found] == ["card", "card"] and "4111111111111112" in out[0].text
    assert re.fullmatch(r"pay \d{4} \d{4} \d{4} \d{4} or \d{16}, not 4111111111111112", out[0].text) and "4111 1111" not in out[0].text
    assert re.fullmatch(r"on \d{4}-\d\d-\d\d, never 2023-02-30; [a-z]\.[a-z]\d@x\.org \(555\)", out[1].text)
    assert re.fullmatch(r"\d+\.\d+\.\d+\.\d+ and 300\.1\.1\.1 call \+1 \(\d{3}\) \d{3}-\d{4} now", out[2].text)
    assert (out[3].text, out[4].text, out[5].text, out[3].n_found) == (None, "", "nothing", 0)
    assert pseudonyms.mask(none, "k").count() == 0

