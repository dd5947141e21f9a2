"""Ids of any type, clashing columns, texts without labels, repeated ids."""

import pytest

from statwright.llm import backoff_lm, decontamination, ngram_jaccard, pseudonyms, toxicity, url_rules


def test_item_ids_may_be_texts(spark):
    words = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, "x " + words), (2, "nothing here"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([("q-10", words), ("q-9", " ".join(words.split()[5:20])), (None, "w1"), ("q-0", "absent words only")], "item_id string, text string")
    for most in (10_000, 16):
        got = {r.doc_id: (r.n_hit, sorted(r["items"], key=lambda v: (v is not None, v))) for r in decontamination.hits(docs, items, 10, most).collect()}
        assert got == {1: (30, [None, "q-10", "q-9"]), 2: (0, []), 3: (0, [])}


def test_clashing_columns_stay(spark):
    pages = spark.createDataFrame([("http://a.net/es/x", "r", "b", "l", "g"), (None, "r", "b", "l", "g")], "url string, _rules string, _best string, labels string, _rule_host string")
    got = url_rules.judge(pages, [url_rules.Rule("block", "net", "/es/")]).collect()
    assert {(r.verdict, r["_rules"], r["_best"], r.labels, r["_rule_host"]) for r in got} == {("block", "r", "b", "l", "g"), ("allow", "r", "b", "l", "g")}
    docs = spark.createDataFrame([(1, "write to ann@example.com", "c", "m", 5, "k")], "doc_id long, text string, _c string, _m string, _row int, _keys string")
    r = pseudonyms.mask(docs, "key").first()
    assert r.n_found == 1 and (r["_c"], r["_m"], r["_row"], r["_keys"]) == ("c", "m", 5, "k") and "ann@" not in r.text
    model, entries = backoff_lm.train(docs)
    r = backoff_lm.score(docs, model, entries).first()
    assert (r["_row"], r["_keys"], r["_c"]) == (5, "k", "c") and r.n_tokens == 4


def test_scores_without_labels(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None), (3, "")], "doc_id long, text string")
    for labels in ([], [(1, None)], [(9, 1)]):
        got = toxicity.score(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
        assert len(got) == 3 and all(r.score == toxicity.UNLABELLED and r.predicted == 0 for r in got)


@pytest.mark.parametrize("order", [1, -1])
def test_of_rows_with_one_id_the_least_text_stays(spark, order):
    rows = [(1, "b b b b b b", "z"), (1, "a a a a a a", "y"), (1, "a a a a a a", "x"), (2, "c d e f g", "w"), (None, "c d e f g", "v")][::order]
    got = ngram_jaccard.deduplicate(spark.createDataFrame(rows, "doc_id long, text string, o string").repartition(3)).collect()
    assert {(r.doc_id, r.text, r.o) for r in got} == {(1, "a a a a a a", "x"), (2, "c d e f g", "w"), (None, "c d e f g", "v")}
