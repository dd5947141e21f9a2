"""Conversation repair, removal of repeated passages and whitening against brute force."""

import collections
import hashlib
import itertools
import json
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from statwright.functions.storage import BATCH_BYTES
from statwright.llm import backoff_lm, conversations, decontamination, substring_dedup, token_codes, whitening
from statwright.llm import queries as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# Conversations

SPEECH = "conv_id long, turn long, role string, text string, place string, copies string"


def talks(seed=5, n=60, longest=9):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randint(0, longest)):
            role = rng.choice(["user", "assistant", "system", "tool", None, "", "Sage", "usher"]) if rng.random() < 0.3 else ["user", "assistant"][t % 2]
            text = rng.choice(["Yes.", "No", "What?! ", " \t", "", None, "Good.\n", "Même", "a.b"]) if rng.random() < 0.6 else f"line {t}."
            rows.append((rng.choice([c, c, c, None]) if c % 9 == 0 else c, rng.choice([t, t, 3 * t, None]), role, text, "x", "y"))
    rng.shuffle(rows)
    return rows


def damage(rows):
    out, names = [], set()
    for conv, turn, role, text, *_ in rows:
        names.add(conv)
        code = zlib.crc32(":".join(" " if v is None else str(v) for v in (conv, turn)).encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        role = "user" if code == 4 else role
        out += [(conv, turn, role, text)] * (2 if code == 3 else 1)
    return out, names


def cheapest(rows, faults):
    """All cheapest edits by going through every sequence of states, ASCII-least first."""
    best = {}

    def go(i, state):
        if (i, state) in best:
            return best[i, state]
        options = []
        if i == len(rows):
            if state in ("", "a"):
                options.append((0, "", ()))
        else:
            cost, edits, out = go(i + 1, state)
            options.append((cost + 2, "D" + edits, out))
            if faults[i] not in ("blank", "duplicate"):
                more = 5 if faults[i] == "truncated" else 0
                for role, letter, price in ((rows[i][2], "K", 0), ("user", "R", 1), ("assistant", "R", 1)):
                    if follows(state, role[:1]):
                        cost, edits, out = go(i + 1, role[:1])
                        options.append((cost + more + price, letter + edits, ((role, rows[i][3]), *out)))
        found = min(options, default=(10 ** 9, "", ()), key=lambda o: o[:2])
        best[i, state] = found
        return found

    def follows(state, initial):
        return (state, initial) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}
    # Insertions are tried between all rows by relaxing until nothing changes, from the end to the front.
    for i in range(len(rows), -1, -1):
        for state in ("", "s", "u", "a"):
            go(i, state)
        for _ in range(4):
            for state, role in (("", "user"), ("s", "user"), ("u", "assistant"), ("a", "user")):
                cost, edits, out = best[i, role[:1]]
                option = (cost + 5, "I" + edits, ((role, ""), *out))
                if option[:2] < best[i, state][:2]:
                    best[i, state] = option
    return best[0, ""]


def repaired(rows):
    kept, names = damage(rows)
    want = {}
    for conv in names:
        own = sorted((r for r in kept if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, faults = set(), []
        for _, _, role, text in own:
            words = re.sub(r"[\x20\x09-\x0D]+$", "", text)
            faults.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else None)
            seen.add((role, text))
        turns = {r[1] for r in own if r[1] is not None}
        bad = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        cost, audit, out = cheapest(own, faults)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
        want[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), bad, cost, audit, digest)
    return want


def reported(spark, rows, schema=SPEECH, most=1 << 16):
    out = conversations.repair(conversations.damaged(spark.createDataFrame(rows, schema).repartition(3)), "copies", most)
    got = out.report.collect()
    assert len({r.conv_id for r in got}) == len(got)
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in got}, out


def test_repairs_are_the_cheapest(spark):
    rows = talks() + talks(8, 40, 30)[:400]
    got, out = reported(spark, rows)
    want = repaired(rows)
    assert {k: (v, want.get(k)) for k, v in got.items() if v != want.get(k)} == {} and got.keys() == want.keys()
    texts = {}
    for r in out.turns.orderBy("place").collect():
        texts.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for conv, v in want.items():
        assert hashlib.sha256("\n".join(texts.get(conv, [])).encode()).hexdigest() == v[-1]
        assert re.fullmatch("(s?(ua)+)?", "".join(t[:1] for t in texts.get(conv, [])))


@pytest.mark.parametrize("rows_a_piece", [1, 3, 50])
def test_long_conversations_are_cut_into_pieces(spark, rows_a_piece):
    """One conversation holds most rows and spans all partitions; some rows are equal."""
    rng = random.Random(2)
    rows = talks(3, 12) + [(500, t // 2 if t % 7 else None, rng.choice(["user", "assistant", "system", "x"]), rng.choice(["Yes.", "No", "", f"t{t}.", f"u{t}"]), "", "") for t in range(400)]
    got, _ = reported(spark, rows, most=rows_a_piece)
    want = repaired(rows)
    assert {k: (v, want.get(k)) for k, v in got.items() if v != want.get(k)} == {} and got.keys() == want.keys()


def test_equal_rows_travel_as_one(spark):
    rows = [(1, None, "user", "Hello.", "", "")] * 500 + [(1, 4, "assistant", "Yes.", "", ""), ("2", 0, None, None, None, None)][:1]
    got, _ = reported(spark, rows)
    assert got == repaired(rows)


def test_conversations_of_text_ids_and_none(spark):
    assert reported(spark, [])[0] == {}
    rows = [("a", 1, "user", "Hi.", "", ""), ("a", 2, "assistant", "Hi.", "", ""), (None, None, None, None, None, None)]
    assert reported(spark, rows, SPEECH.replace("conv_id long", "conv_id string"))[0] == repaired(rows)


def test_walk_equals_the_plain_program():
    rng = random.Random(1)
    for size in (0, 1, 2, 7, 80, 900):
        codes = bytes(rng.choice([0, 1, 1, 2, 2, 3, 5, 6, 7, 8]) for _ in range(size))
        v, total = conversations.before(codes, conversations.END)
        state, cost = 0, 0
        for (letters, after), code in zip(conversations.walk(codes, conversations.END, 0), codes, strict=True):
            cost += sum({"D": 2, "I": 5, "R": 1, "K": 0}[c] for c in letters) + (5 if code & 4 and letters[-1] in "KR" else 0)
            state = after
        assert cost + 5 * len(conversations.closing(state)) == v[0] + total


# Repeated passages

def without_repeats(rows, window):
    texts = [WORD.findall(r[1] or "") for r in rows]
    seen = {}
    for d, w in enumerate(texts):
        for i in range(len(w) - window + 1):
            seen.setdefault(tuple(w[i:i + window]), []).append((d, i))
    gone = [set() for _ in texts]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                gone[d].update(range(i, i + window))
    return [(r[0], len(w), len(g), " ".join(x for i, x in enumerate(w) if i not in g)) for r, w, g in zip(rows, texts, gone, strict=True)]


def copied(seed=1, window=35):
    rng = random.Random(seed)
    words = ["a", "é", "Word", "word", "x　y", "long" * 9] + [f"w{i}" for i in range(60)]
    draw = lambda n: [rng.choice(words) for _ in range(n)]
    passages = [draw(k) for k in (max(1, window - 1), window, window + 1, 2 * window, 5 * window)]
    texts = [None, "", "  ", "one", " ".join(["a"] * (3 * window)), " ".join(["a", "b"] * window)]
    for i in range(80):
        own = draw(rng.randint(0, 4 * window))
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(len(own) + 1)
            cut = rng.choice(passages)
            a = rng.randrange(len(cut))
            own[at:at] = cut if rng.random() < 0.6 else cut[a:a + rng.randint(1, window + 5)]
        texts.append(rng.choice([" ", "\n", "  \t"]).join(own) + rng.choice(["", " "]))
    texts += [texts[20], texts[20], texts[30]] + [f"hot {i} " + " ".join(passages[3]) for i in range(30)]
    return [(rng.choice([i, i, 7, None]), t, "a", "b", 1, 2) for i, t in enumerate(texts)]


CLASH = "doc_id long, text string, kept string, _f string, n_words int, _own_0 int"


@pytest.mark.parametrize("window,bits", [(35, 28), (35, 8), (1, 20), (2, 20), (8, 6)])
def test_repeats_are_removed_exactly(spark, window, bits):
    rows = copied(window, window)
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, CLASH).repartition(5), window, bits)
    assert got.columns == ["doc_id", "text", "_f", "_own_0", "n_words", "n_removed", "kept"]
    plain = lambda x: sorted(x, key=repr)
    assert plain((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got.collect()) == plain(without_repeats(rows, window))


def test_long_text_and_empty_table(spark):
    rng = random.Random(4)
    text = " ".join(f"v{rng.randrange(10 ** 9)}" for _ in range(60_000))
    piece = " ".join(text.split()[40_000:40_050])
    rows = [(1, text + "\x0c" + piece, "", "", 1, 1), (2, "x " * 30_000, "", "", 1, 1)]
    got = {(r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, CLASH)).collect()}
    assert got == set(without_repeats(rows, 35))
    assert substring_dedup.remove_repeats(spark.createDataFrame([], CLASH)).count() == 0


def test_query_of_repeats(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in Q.table(spark, folder, "documents").select("doc_id", "text").collect()]
    want = {(d, n, g, hashlib.sha256(t.encode()).hexdigest()) for d, n, g, t in without_repeats(rows, 35)}
    assert {tuple(r) for r in Q.QUERIES["op12_substring_dedup"](spark, folder).collect()} == want


# Whitening

VECTORS = "vec_id long, embedding array<double>, n string, _x string, whitened string"


def by_hand(rows, components=4, scale=256):
    """Exact sums with fractions, then numpy."""
    good = [(i, [int(np.floor(scale * c)) for c in v]) for i, v, *_ in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in good})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(d)]
    cov = [[Fraction(n * sum(x[i] * x[j] for x in fit) - sums[i] * sums[j], n * n) for j in range(d)] for i in range(d)]
    values, vectors = whitening.principal(np.array([[whitening.long_double(v.numerator) / whitening.long_double(v.denominator) for v in row] for row in cov]))
    values, vectors = values.astype(float), vectors.astype(float)
    top = np.argsort(-values)[:components]
    spread = float(sum(cov[i][i] for i in range(d)))
    out = {}
    for k, (i, x) in enumerate(good):
        z = np.array([float(Fraction(n * x[j] - sums[j], n)) for j in range(d)]) @ vectors[:, top] / np.sqrt(values[top])
        out[k, i] = (n, sum((n * x[j] - sums[j]) ** 2 for j in range(d)), z, values[top] / spread)
    return out


def vectors(seed=3, n=300, dims=7, shift=0.0, spread=1.0):
    rng = np.random.default_rng(seed)
    turn = rng.normal(size=(dims, dims))
    v = rng.normal(size=(n, dims)) @ (turn * np.arange(1, dims + 1)) * spread + shift
    rows = [(int(i), [float(c) for c in x], "a", "b", "c") for i, x in enumerate(v)]
    odd = [(None, rows[0][1]), (3, rows[4][1]), (900, None), (901, [None] * dims), (902, [float("nan")] + [0.0] * (dims - 1)), (903, [float("-inf")] + [0.0] * (dims - 1)),
           (904, [-0.0] * dims), (905, [1e-300] * dims)]
    return rows + [(*r, "a", "b", "c") for r in odd] + rows[:100]


@pytest.mark.parametrize("shift,spread", [(0.0, 1.0), (1e6, 1e-2), (-3.0, 1e5)])
def test_whitening_is_exact(spark, shift, spread):
    rows = vectors(shift=shift, spread=spread)
    want = by_hand(rows)
    got = whitening.whiten(spark.createDataFrame(rows, VECTORS).coalesce(1)).collect()
    assert len(got) == len(want) and {r.n for r in got} == {next(iter(want.values()))[0]}
    signs = None
    for r, ((_, i), (n, deviation, z, share)) in zip(got, want.items(), strict=True):
        assert r.vec_id == i and r.n == n and int(r.deviation) == deviation and r["_x"] == "b"
        signs = np.sign(np.array(r.whitened) / z) if signs is None else signs
        assert np.allclose(np.array(r.whitened) * signs, z, rtol=1e-7, atol=1e-7) and np.allclose(r.explained, share, rtol=1e-9)
        assert r.identity_error < 1e-6
    distinct = {tuple(np.floor(256 * np.array(x[1]))): np.array(r.whitened) for x, r in zip([x for x in rows if x[1] and None not in x[1] and np.isfinite(x[1]).all()], got, strict=True)}
    z = np.array(list(distinct.values()))
    assert np.abs(z.T @ z / len(z) - np.eye(4)).max() < 1e-6 and np.abs(z.mean(axis=0)).max() < 1e-6


def test_principal_axes_keep_small_values():
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.normal(size=(6, 6)))
    q = q.astype(np.longdouble)
    q = q @ (3 * np.eye(6) - q.T @ q) / 2
    for sizes in ([9, 5, 4, 3, 2, 1], [1e14, 1e8, 50, 2, 1, 0.5], [1e12, 1e12, 1, 1, 1, 1], [7, 3, 0, 0, 0, 0], [0] * 6):
        values, vectors = whitening.principal((q * np.array(sizes, dtype=np.longdouble)) @ q.T)
        assert np.allclose(values.astype(float), sizes, rtol=1e-4, atol=1e-18)
        assert np.abs(vectors.T @ vectors - np.eye(6)).max() < 1e-17
        for k, size in enumerate(sizes):
            if sizes.count(size) == 1:
                assert abs(float(vectors[:, k] @ q[:, k])) == pytest.approx(1, abs=1e-9)


def test_products_of_any_size():
    rng = np.random.default_rng(1)
    for rows, dims, low, high in [(1, 3, -5, 5), (200, 4, -(1 << 62), 1 << 62), (1000, 5, 7, 8), (130, 2, -(1 << 30), 1 << 30), (64, 1, 0, 2)]:
        x = rng.integers(low, high, (rows, dims))
        if rows == 200:
            x[0], x[1] = -(1 << 63), (1 << 63) - 1
        one = np.concatenate([np.ones((rows, 1), dtype=np.int64), x], axis=1).astype(object)
        assert (np.triu(whitening.products(x)) == np.triu(one.T @ one)).all()


def test_few_vectors_and_odd_tables(spark):
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None, "", "", "")], VECTORS)).count() == 0
    one = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.5], "", "", ""), (2, [0.5, 0.5], "", "", "")], VECTORS)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, [None, None], [None, None], None)] * 2
    two = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.0, 1.0], "", "", ""), (2, [0.25, 0.0, 2.0], "", "", ""), (3, [1.0], "", "", ""), (4, [], "", "", "")], VECTORS)).orderBy("vec_id").collect()
    assert len(two) == 2 and two[0].explained == pytest.approx([1, 0, 0]) and two[0].whitened[1:] == [None, None] and abs(two[0].whitened[0]) == pytest.approx(1)
    huge = whitening.whiten(spark.createDataFrame([(1, [1e300, 0.0], "", "", ""), (2, [-1e300, 1.0], "", "", ""), (3, [4.0, -1e30], "", "", "")], VECTORS)).collect()
    assert len(huge) == 3 and all(r.n == 3 for r in huge)


def test_query_of_whitening(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.vec_id, [float(c) for c in r.embedding]) for r in Q.table(spark, folder, "embeddings").collect()]
    want = {i: v for (_, i), v in by_hand(rows).items()}
    got = Q.QUERIES["op13_embedding_whitening"](spark, folder)
    assert got.select(F.count("*")).first()[0] == 4 * len(want)
    for r in got.filter("vec_id % 50 = 0").collect():
        n, deviation, z, share = want[r.vec_id]
        assert (r.n, r.deviation) == (n, deviation) and abs(r.whitened) == pytest.approx(abs(z[r.component - 1]), abs=1e-9)
        assert r.explained == pytest.approx(share[r.component - 1]) and r.identity_error < 1e-4


def test_every_bigram_of_the_training_texts_is_an_arc(spark, monkeypatch):
    """A bigram seen once is learned, in one piece of text or many; learned and unknown texts, empty and null ones."""
    texts = ["a b a b c", "a b x y", "A\tb z", "", None, "c a", "once only here", "a b x y q", "y x", "here once", "only here"] * 2 + ["last word"]
    rows = [(i, t, "o", i) for i, t in enumerate(texts)]
    seqs = {i: [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()), "\0end"] for i, t, *_ in rows}
    for learned in (lambda i: i % 3 != 1, lambda i: i < 11, lambda i: i == 6, lambda i: False):
        c, pair, n = collections.Counter(), collections.Counter(), 0
        for i, w in seqs.items():
            if learned(i):
                c.update(w)
                pair.update(zip(["\0begin", *w], w, strict=False))
                n += len(w)
        history = c + collections.Counter({"\0begin": sum(map(learned, seqs))})
        one, two = (sum(k == m for k in pair.values()) for m in (1, 2))
        discount = one / (one + 2 * two) if one and two else 0.5
        after = collections.Counter(v for v, _ in pair)
        for most in (1 << 22, 12):
            with monkeypatch.context() as m:
                m.setattr(backoff_lm, "CHUNK", most)
                df = spark.createDataFrame(rows, "doc_id long, text string, own string, piece int").repartition(1 if most > 99 else 7)
                wanted = F.col("doc_id").isin([i for i in seqs if learned(i)])
                got = {r.doc_id: r for r in backoff_lm.corpus(df, wanted).collect()}
            assert len(got) == len(rows)
            for i, t, own, piece in rows:
                r, base, score = got[i], 0.0, 0.0
                assert (r.text, r.own, r.piece, r.n_tokens, r.n_known, r.train_tokens) == (t, own, piece, len(seqs[i]), sum(c[x] > 0 for x in seqs[i]), n)
                for v, x in zip(["\0begin", *seqs[i]], seqs[i], strict=False):
                    root = (c[x] + 1) / (n + len(c) + 1)
                    base += math.log10(root)
                    k = pair[v, x]
                    score += math.log10(((k - discount if k else 0) + discount * after[v] * root) / history[v] if history[v] else root)
                assert math.isclose(r.base_score, base, rel_tol=1e-9, abs_tol=1e-9) and math.isclose(r.score, score, rel_tol=1e-9, abs_tol=1e-9)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert backoff_lm.corpus(empty, F.lit(True)).count() == 0


def test_pieces_go_to_a_worker_one_by_one(spark, monkeypatch):
    """Counts that came back make a piece large; pieces of one task are not held together, and the session's batch size stays."""
    before = spark.conf.get(BATCH_BYTES)
    own = backoff_lm.by_piece

    def alone(df, make, schema):
        def run(batches):
            for b in batches:
                assert b.num_rows == 1, "pieces in one batch"
                yield b
        return own(df.mapInArrow(run, df.schema), make, schema)
    monkeypatch.setattr(backoff_lm, "by_piece", alone)
    monkeypatch.setattr(backoff_lm, "ALONE", 1)
    df = spark.createDataFrame([(i, f"a b {i % 5}") for i in range(48)], "doc_id long, text string").repartition(24)
    got = backoff_lm.corpus(df, F.lit(True)).collect()
    assert len(got) == 48 and {r.n_tokens for r in got} == {4} and {r.train_tokens for r in got} == {192}
    assert spark.conf.get(BATCH_BYTES) == before


def test_words_asked_together_have_the_ids_of_each_alone(monkeypatch):
    """Words with the mark in them, odd blanks, joiners and broken bytes; a full store of known words; few questions."""
    path = Q.tokenizer_path()
    fresh = token_codes.Known(path)
    words = ["ab", "\x01", "a\x01b", "\x01\x01", "don't", "'s", "x y", "́e", "é", "é", "<|endoftext|>", "‍", "9", "\U0001f600", "\x1c", " z", "ΟΔΟΣ"]
    words += [f"w{i}q" for i in range(3000)]
    alone = [fresh.tokenizer.encode(x, add_special_tokens=False).ids for x in words]
    assert fresh.mark >= 0
    for some in (words, words[:17], words[17:], words[:1], []):
        size, ids = fresh.ask([x.encode() for x in some])
        want = alone[:len(some)] if some is not words[17:] and some != words[17:] else alone[17:]
        assert size.tolist() == [len(x) for x in want] and ids.tolist() == [y for x in want for y in x]
    token_codes.known_words.cache_clear()
    asked, ask = [], token_codes.Known.ask
    monkeypatch.setattr(token_codes.Known, "ask", lambda self, x: asked.extend(x) or ask(self, x))
    rng = random.Random(3)
    texts = [" ".join(rng.choices(words, k=400)) for _ in range(40)]
    for most in (1 << 20, 900, 50):
        monkeypatch.setattr(token_codes, "CACHE_WORDS", most)
        token_codes.known_words(path).clear()
        asked.clear()
        for t in texts:
            _, ids = token_codes.encode(pa.array([t]), path)
            assert ids.tolist() == fresh.tokenizer.encode(t, add_special_tokens=False).ids
        if most > len(words):
            assert len(asked) == len(set(asked))  # words seen once in a piece are remembered too
    token_codes.known_words.cache_clear()


def test_words_are_asked_by_their_parts(monkeypatch, tmp_path):
    """Case and signs at a word make no new word; words of other letters, apostrophes and special tokens stay whole; other tokenizers too."""
    path = Q.tokenizer_path()
    asked, ask = [], token_codes.Known.ask
    monkeypatch.setattr(token_codes.Known, "ask", lambda self, x: asked.extend(x) or ask(self, x))
    token_codes.known_words.cache_clear()
    _, ids = token_codes.encode(pa.array(["Haus haus, HAUS. Größe", "größe.haus,7,77 Haus%%%"]), path)
    assert sorted(x.decode().lower() for x in asked) == sorted(["haus", ",", ".", "größe", "7", "%%%"])
    plain = token_codes.Known(path).tokenizer
    assert plain.encode("Haus haus, HAUS. Größe größe.haus,7,77 Haus%%%", add_special_tokens=False).ids == ids.tolist()
    rng = random.Random(4)
    signs = [*"abzAZ09.,'!<|>\t\n \x1c\x7f\x00\x01\x85\xa0éÉßÿÞ×÷ªΣςİ…́Жǅ中", "é", "'s", "'LL", "<|endoftext|>", "<|ENDOFTEXT|>", "Haus", " "]
    other = json.loads(plain.to_str())
    other["normalizer"]["normalizers"].pop()
    (tmp_path / "cased.json").write_text(json.dumps(other))
    for file in (path, str(tmp_path / "cased.json")):
        known = token_codes.known_words(file)
        assert known.cuts == (file == path)
        texts = ["".join(rng.choices(signs, k=k % 60)) for k in range(600)] + [None]
        first, ids = token_codes.encode(pa.array(texts, pa.string()), file)
        for i, t in enumerate(texts):
            assert ids[first[i]:first[i + 1]].tolist() == known.tokenizer.encode(t or "", add_special_tokens=False).ids
    token_codes.known_words.cache_clear()


def test_decontamination_has_one_python_step(spark):
    """Spans are cut out by bytes, at both ends and in the middle, and no second Python worker waits in the stage."""
    item = "one two three four five six seven eight nine ten"
    texts = {0: None, 1: "", 2: "öde – Größe", 3: f"Ö-{item}; {'ß ' * 30}é", 4: f"{'日本 ' * 15}{item}", 5: f"{item} {'x ' * 25}{item.upper()}\n{'y ' * 15}…",
             6: item, 7: f"{'a ' * 20}{item}, {item} {'b ' * 20}"}
    docs = spark.createDataFrame([(k, t, len(t or "")) for k, t in texts.items()], "doc_id long, text string, n_chars long")
    items = spark.createDataFrame([("i", item)], "item_id string, text string")
    clean = decontamination.decontaminate(docs, items)
    assert len(re.findall("MapInArrow", clean._jdf.queryExecution().executedPlan().toString())) == 1
    found = {r.doc_id: r for r in decontamination.hits(docs, items).collect()}
    want = {}
    for k, t in texts.items():
        if found[k].n_hit * 2 <= found[k].n_words:
            raw, at, keep = (t or "").encode(), 0, []
            for a, b in found[k].spans:
                keep.append(raw[at:a])
                at = b
            want[k] = b" ".join([*keep, raw[at:]]).decode() if found[k].spans else t
    assert set(want) == {0, 1, 2, 3, 4, 5, 7} and sum(x.n_hit > 0 for x in found.values()) == 5
    assert {r.doc_id: (r.text, r.n_chars) for r in clean.collect()} == {k: (t, len(t or "")) for k, t in want.items()}
