"""Golden cases and invariants of the table operators."""

import inspect
import math

import pytest
from pyspark.sql import functions as F

from strophe.operators import counts as C, joins as J, ordered as O, rows as R, sampling as S, sections as E, substrings as B, terms as K
from strophe.operators.positions import Positions
from strophe.sources.staging import stage


def test_argmax_columns(spark, rows):
    df = spark.createDataFrame(
        [(False,) * 5, (False, True, False, True, False), (None, None, None, None, True)],
        "is_country boolean, is_pop boolean, is_rap boolean, is_rb boolean, is_rock boolean")
    assert rows(df.select(R.argmax_columns(df.columns))) == [("is_country",), ("is_pop",), ("is_rock",)]


def test_one_hot(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "id int, tag string")
    out = R.one_hot(df, "tag", "is")
    assert out.columns == ["id", "is_a", "is_b"]
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, False, True), (2, True, False), (3, False, False)]
    with pytest.raises(ValueError):
        R.one_hot(df, "tag", "is", max_columns=1)


def test_exclude_value_keeps_null(spark, rows):
    df = spark.createDataFrame([("misc",), ("pop",), (None,)], "tag string")
    assert sorted(rows(R.exclude_value(df, "tag", "misc")), key=str) == [("pop",), (None,)]


def test_labels_go_both_ways(spark):
    df = spark.createDataFrame([("joy",), ("trust",), ("other",)], "label string")
    out = df.withColumn("i", R.encode_label(F.col("label"))).withColumn("back", R.decode_label(F.col("i")))
    assert [tuple(r) for r in out.collect()] == [("joy", 4, "joy"), ("trust", 7, "trust"), ("other", None, None)]


# Ordered totals: a hot group that spans slices, next to small ones.

@pytest.fixture(scope="module")
def hot(spark):
    return spark.range(0, 3000, 1, 5).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("key"),
        F.md5(F.col("id").cast("string")).alias("o"), (F.col("id") % 5).alias("v"))


@pytest.mark.parametrize("slices", [1, 4, 13])
def test_numbered_is_row_number(spark, hot, slices):
    mine = {(r["key"], r["o"]): r["n"] for r in O.numbered(hot, ["key"], ["o"], "n", slices=slices).collect()}
    expected, seen = {}, {}
    for key, o in sorted((r["key"], r["o"]) for r in hot.collect()):
        expected[key, o] = seen.get(key, 0)
        seen[key] = seen.get(key, 0) + 1
    assert mine == expected


def test_running_totals_descending(hot):
    got = O.running_totals(hot, ["key"], [F.desc("o")], {"t": F.col("v")}, slices=6)
    total = {}
    for r in sorted(hot.collect(), key=lambda r: r["o"], reverse=True):
        total[r["key"]] = total.get(r["key"], 0) + r["v"]
        total[r["key"], r["o"]] = total[r["key"]]
    assert all(total[r["key"], r["o"]] == r["t"] for r in got.collect())


def test_null_keys_and_global_ids(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), (None, 4)], "k string, o int")
    got = {r["o"]: r["n"] for r in O.cumcount(df, ["k"], ["o"]).collect()}
    assert got == {1: 0, 2: 1, 3: 0, 4: 2}
    assert sorted(r["id"] for r in O.with_row_id(df, ["o"]).collect()) == [0, 1, 2, 3]


# Joins

@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_and_broadcast_lookup_agree(spark, hot, how):
    table = stage(spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3)], "key string, w int"))
    small = J.lookup_join(hot, table, ["key"], how)
    large = J.lookup_join(hot, table, ["key"], how, broadcast_bytes=2)
    key = ["key", "o", "v", "w"]
    assert "Broadcast" in small._jdf.queryExecution().simpleString()
    assert sorted(map(str, small.select(key).collect())) == sorted(map(str, large.select(key).collect()))


def test_only_hot_keys_are_copied(spark, hot, monkeypatch):
    monkeypatch.setattr(J, "HOT_ROWS", 500)
    facts = hot.withColumn("key", F.when(F.col("v") > 0, F.col("key")))
    keys = J.hot_keys(facts, ["key"])
    assert sorted(r["key"] or "" for r in keys.collect()) == ["", "hot"]  # the rows without a key are many too
    table = stage(spark.createDataFrame([("hot", 1), *[(f"k{i}", i) for i in range(200)], (None, 7)], "key string, w int"))
    assert J._copies(table, keys, ["key"], 32).count() == 202 + 31
    small = facts.join(table, "key", "left")
    assert sorted(map(str, small.collect())) == sorted(map(str, J.salted_join(facts, table, ["key"], "left").select(small.columns).collect()))


def test_substring_matches(spark, rows):
    tags = spark.createDataFrame([("[Ann]",), ("[Bobby]",), ("[Verse]",), ("[Ann]",), (None,)], "tag string")
    names = spark.createDataFrame([("Ann",), ("Bo",), ("",), (None,), ("Verse]x",)], "artist string")
    assert sorted(rows(B.substring_matches(tags, "tag", names, "artist"))) == [("[Ann]",), ("[Bobby]",)]
    assert rows(B.substring_matches(tags, "tag", names.where("artist = ''"), "artist")) == []


def test_substring_matches_brute_force(spark, rows):
    words = [f"w{i * 7919 % 1009:x}{'ab' * (i % 9)}" for i in range(120)]
    needles = [w[i % 3: i % 3 + 1 + i % 17] for i, w in enumerate(words)] + ["zz"]
    got = rows(B.substring_matches(spark.createDataFrame([(w,) for w in words], "t string"), "t",
                                   spark.createDataFrame([(n,) for n in needles], "n string"), "n"))
    assert sorted(got) == sorted({(w,) for w in words if any(n and n in w for n in needles)})


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, 0])
def test_substring_matches_short_needles_and_long_texts(spark, rows, broadcast_bytes):
    """A one-letter needle, needles of every length, a text of 100 kB, repeated texts; both ways of joining."""
    long = " ".join(f"w{i * 7919 % 10_007:x}" for i in range(20_000))
    assert len(long) > 90_000
    texts = [long, long + " needle", "z", "", None, "abc", "abcabc", "na\u00efve \u2615", "one two three"] + ["copy of one text"] * 50
    table = spark.createDataFrame([(t, 1) for t in texts], "t string, other int")
    for needles in (["z"], ["\u2615"], ["ab", "two"], [long[50_000:50_200]], ["needle", "w1e", ""], ["of one", "bca", "xyz", None], ["abcd"], []):
        got = rows(B.substring_matches(table, "t", spark.createDataFrame([(n,) for n in needles], "n string"), "n", broadcast_bytes=broadcast_bytes))
        assert sorted(got) == sorted({(t,) for t in texts if t and any(n and n in t for n in needles)}), needles


def test_rarest_gram_is_chosen(spark, rows):
    index = spark.createDataFrame([(i, g) for i, gs in enumerate(["abcd", "abcd bcde", "abcd bcde cdef"]) for g in gs.split()], "_id int, _gram string")
    needles = spark.createDataFrame([("n1", "abcd"), ("n1", "bcde"), ("n2", "abcd"), ("n3", "abcd"), ("n3", "none")], "_needle string, _gram string")
    assert sorted(rows(B.rarest_grams(needles, index))) == [("abcd", "n2"), ("bcde", "n1")]


def test_dictionary_leaves_the_wide_row_where_it_is(spark):
    from strophe.sources.staging import stage
    lemmas = stage(spark.createDataFrame([(f"w{i}", f"l{i % 7}") for i in range(500)] + [("w1", "a"), (None, "n")], "token string, lemma string"))
    data = [(1, ["w1", "zz", "w499", ",", "w1"]), (2, None), (3, []), (4, ["w3", None])]
    df = spark.createDataFrame(data, "id int, tokens array<string>")
    near = K.lemmatize(df, ["id"], "tokens", lemmas)
    plan = near._jdf.queryExecution().optimizedPlan().toString().split("scalar-subquery")[0]
    assert "Join" not in plan and "Aggregate" not in plan
    far = K.lemmatize(df.where("id < 4"), ["id"], "tokens", lemmas.where("token is not null and lemma <> 'l1' or token <> 'w1'"), broadcast_bytes=0)
    got = {r.id: r.lemmas for r in near.collect()}
    assert got[1] == ["a", "zz", "l2", "a"] and got[2] is None and got[3] == [] and got[4] == ["l3"]
    assert {r.id: r.lemmas for r in far.collect()} == {k: v for k, v in got.items() if k < 4}


def test_dictionary_takes_a_batch_in_parts(spark, monkeypatch):
    """Results do not depend on where a part ends, and no word of a batch becomes an object of Python."""
    from strophe.operators import dictionary as D
    data = [["a", "b", None, "c"], [], None, ["b"], ["zz", "a", "a", "b", "a"], []]
    monkeypatch.setattr(D, "PART", 3)
    assert "to_pylist" not in inspect.getsource(D.Dictionary)
    df = spark.createDataFrame(list(enumerate(data)), "id int, t array<string>").coalesce(1)
    words = D.Dictionary([("a", "x"), ("b", "y")]).replace(F.col("t"))
    sums = D.Dictionary([("a", [1.0, 0.5]), ("b", [0.0, 2.0])]).summed(F.col("t"), 2)
    got = [(r.w, r.s) for r in df.select("id", words.alias("w"), sums.alias("s")).orderBy("id").collect()]
    assert got == [(["x", "y", None, "c"], [1.0, 2.5]), ([], [0.0, 0.0]), (None, [0.0, 0.0]), (["y"], [0.0, 2.0]),
                   (["zz", "x", "x", "y", "x"], [3.0, 3.5]), ([], [0.0, 0.0])]


def test_induced_lexicon_by_plain_counting(spark):
    import math
    from strophe.operators.lexicon import associations, induced_lexicon, seed_terms
    texts = [["sun", "warm", "day"], ["sun", "day", "day"], ["grave", "cold"], ["grave", "night", "cold"], ["night"], [], None, ["sun", "grave"]]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t array<string>")
    seeds = {"joy": ["sun"], "fear": ["grave", "crypt"]}
    got = {(r.term, r.label): (r.df, r.together, round(r.pmi, 9)) for r in associations(df, "t", seeds, ["joy", "fear", "trust"], min_df=1).collect()}
    n, bags = len(texts), [set(t or []) for t in texts]
    for term in set().union(*bags):
        for label, words in [*seeds.items(), ("trust", [])]:
            df_, m = sum(term in b for b in bags), sum(bool(b & set(words)) for b in bags)
            both = sum(term in b and bool(b & set(words)) for b in bags)
            assert got[(term, label)] == (df_, both, round(math.log((both + 1) * (n + 1) / ((df_ + 1) * (m + 1))), 9))
    lexicon = {(r.term, r.label) for r in induced_lexicon(df, "t", seeds, ["joy", "fear"], k=2, min_df=2).collect()}
    assert ("sun", "joy") in lexicon and ("cold", "fear") in lexicon and ("day", "fear") not in lexicon
    assert seed_terms(df, "t", ["joy", "fear"], per_label=1, max_df=0.5) == {"joy": ["grave"], "fear": ["sun"]}


# Sections

def test_stanza_rows_and_flags(spark):
    from strophe.plans.songs import split_songs, unique_stanzas

    text = "same words again and again\n\nsame words again and again\n\nanother stanza that is unique"
    songs = spark.createDataFrame([(1, "t", "a", text), (2, "t", "a", "short"), (3, "t", "a", None)],
                                  "id bigint, title string, artist string, lyrics string")
    out = split_songs(songs).orderBy("id", "stanza_number").select("id", "stanza_number", "is_chorus", "stanzas")
    assert [tuple(r)[:3] for r in out.collect()] == [
        (1, 0, True), (1, 1, True), (1, 2, False), (2, 0, False), (3, 0, False)]
    kept = unique_stanzas(split_songs(songs)).orderBy("id", "stanza_number").select("id", "stanza_number").collect()
    assert [tuple(r) for r in kept] == [(1, 0), (1, 2), (2, 0)]


def test_row_flags_match_in_row_flags(spark):
    song = "[Chorus]\nsome words to sing along\n\nother words to sing along\n\nother words to sing along"
    df = spark.createDataFrame([(1, song), (2, "x")], "id bigint, lyrics string")
    from strophe.functions.text import drop_uninformative, split_stanzas

    cut = df.select("id", drop_uninformative(split_stanzas(F.col("lyrics"))).alias("s"))
    inside = E.explode_stanzas(cut, "s", chorus="is_chorus").select("id", "stanza_number", "is_chorus")
    after = E.flag_chorus(E.explode_stanzas(cut, "s"), ["id"]).select("id", "stanza_number", "is_chorus")
    assert sorted(map(tuple, inside.collect())) == sorted(map(tuple, after.collect()))


def test_dedup_combines_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, "x"), (0, "x"), (2, None), (3, None)], "id int, t string")
    out = E.dedup_keep_first(df, ["t"], ["id"])
    assert sorted(r["id"] for r in out.collect()) == [0, 2]
    assert out._jdf.queryExecution().toString().count("WindowGroupLimit") >= 2


# Sampling

@pytest.mark.parametrize("parts", [1, 7])
def test_stratified_sizes_and_independence_of_partitions(spark, parts):
    sizes = {"a": 10, "b": 30, "c": 50, "d": 100}
    data = [(f"{g}{i}", g) for g, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(data, "id string, tag string").repartition(parts)
    got = S.stratified_sample(df, "tag", 0.05).collect()
    counts = {g: sum(r["tag"] == g for r in got) for g in sizes}
    assert counts == {"a": 0, "b": 2, "c": 2, "d": 5}
    import hashlib

    order = lambda x: (hashlib.md5(f"42:{x}".encode()).hexdigest(), x)
    assert {r["id"] for r in got if r["tag"] == "d"} == set(
        sorted((i for i, g in data if g == "d"), key=order)[:5])


def test_splits(spark):
    df = spark.range(100).withColumn("label", F.lit("x"))
    parts = {r["split"]: r["count"] for r in S.train_val_test(df).groupBy("split").count().collect()}
    assert parts == {"test": 30, "val": 21, "train": 49}
    for n, test in ((10, 3), (11, 4)):
        assert S.random_split(spark.range(n), 0.3).where("split = 'test'").count() == test
    assert S.random_split(spark.range(0), 0.3).count() == 0
    assert S.sample_n(spark.range(20), 7).count() == 7
    assert S.sample_n(spark.range(5), 7).count() == 5


def test_downsample_and_weights(spark):
    df = spark.range(17).withColumn("label", F.expr("case when id < 5 then 'a' when id < 8 then 'b' else 'c' end"))
    sample = S.downsample(df)
    assert {r["count"] for r in sample.groupBy("label").count().collect()} == {3}
    assert S.not_sampled(df, sample).count() == 17 - 9
    weights = S.class_weights(spark.createDataFrame([("a",), ("b",), ("b",), ("b",)], "label string"))
    assert {r["label"]: round(r["weight"], 6) for r in weights.collect()} == {"a": 2.0, "b": 0.666667}


def test_folds_are_balanced_and_groups_stay_together(spark):
    df = spark.range(53).withColumn("label", F.expr("if(id < 20, 'a', 'b')"))
    sizes = S.kfold(df, 5).groupBy("label", "fold").count().collect()
    assert {r["count"] for r in sizes if r["label"] == "a"} == {4}
    assert {r["count"] for r in sizes if r["label"] == "b"} == {6, 7}
    stanzas = spark.range(60).withColumn("song_id", F.col("id") % 10)
    split = S.split_groups(stanzas, 0.3, "song_id")
    assert split.groupBy("song_id").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0
    assert split.where("split = 'test'").count() == 18


# Counts

def test_histogram(spark):
    df = spark.createDataFrame([(x,) for x in (0, 1, 10000, 10001, 990001, 1000001)], "views bigint")
    got = {r["bin"]: r["n"] for r in C.histogram(df, "views", 10000, 100).collect()}
    assert len(got) == 100 and {b: n for b, n in got.items() if n} == {0: 2, 1: 1, 99: 2}


# Terms

def docs(spark, *texts, by=None):
    data = [(i, text.split(), by[i] if by else "x") for i, text in enumerate(texts)]
    return spark.createDataFrame(data, "doc bigint, tokens array<string>, label string")


def test_mean_tfidf_ranking(spark):
    df = docs(spark, "baby night sun", "baby baby run", "run run night moon")
    got = [(r["term"], round(r["weight"], 6)) for r in
           K.key_terms(df, "doc", "tokens", ["label"]).orderBy("rank").collect()]
    assert got == [("baby", .470761), ("run", .406073), ("night", .30112), ("sun", .226973), ("moon", .168963)]


def test_max_df_drops_common_terms(spark):
    df = docs(spark, "baby night", "baby baby run")
    got = {r["term"]: r["weight"] for r in K.key_terms(df, "doc", "tokens", ["label"]).collect()}
    assert got == {"night": .5, "run": .5}


def test_rows_have_unit_length_and_empty_documents_count(spark):
    df = docs(spark, "a a b", "b c", "")
    weights = K.tfidf(df, "doc", "tokens")
    norms = weights.groupBy("doc").agg(F.sum(F.pow("weight", F.lit(2))).alias("n")).collect()
    assert all(math.isclose(r["n"], 1.0) for r in norms) and len(norms) == 2
    posted = stage(K.postings(df, "doc", "tokens"))
    terms = {r["term"]: r["idf"] for r in K.fit_terms(posted, df).collect()}
    assert math.isclose(terms["b"], math.log(4 / 3) + 1)


def test_chi2(spark):
    df = docs(spark, "x x", "x y", "y y y", by=["A", "A", "B"])
    posted = stage(K.postings(df, "doc", "tokens", ["label"]))
    got = {r["term"]: r["chi2"] for r in K.chi2_scores(posted, df, "label").collect()}
    assert {t: round(v, 9) for t, v in got.items()} == {"x": 1.5, "y": 3.125}
    best = K.chi2_select(posted, df, "label", k=1, min_df=1, max_df=1.0)
    assert [r["term"] for r in best.collect()] == ["y"]


def test_vocabulary_and_sequences(spark):
    df = docs(spark, "a a b c c")
    every = {r["term"]: r["idx"] for r in K.fit_vocab(df, "doc", "tokens", 100).collect()}
    assert every == {"a": 2, "c": 3, "b": 4}
    vocab = K.fit_vocab(df, "doc", "tokens", 4)
    new = docs(spark, "a b d", "", "c a")
    seqs = {r["doc"]: r["sequence"] for r in K.to_sequences(new, "doc", "tokens", vocab).collect()}
    assert seqs == {0: [2, 1, 1], 1: [], 2: [3, 2]}
    padded = {r["doc"]: r["sequence"] for r in K.to_sequences(new, "doc", "tokens", vocab, 2).collect()}
    assert padded == {0: [2, 1], 1: [0, 0], 2: [3, 2]}


def test_first_seen_order_breaks_ties(spark):
    df = docs(spark, "z y", "y z x x")
    assert {r["term"]: r["idx"] for r in K.fit_vocab(df, "doc", "tokens").collect()} == {"z": 2, "y": 3, "x": 4}


def test_scaling(spark):
    df = spark.createDataFrame([(1,), (3,)], "n int")
    scaling = K.fit_scaling(df, "n")
    assert [r[0] for r in df.select(scaling.apply(F.col("n"))).collect()] == [-1.0, 1.0]
    assert K.fit_scaling(df.where("n = 1"), "n").std == 1.0


def test_lemmas(spark):
    words = spark.createDataFrame([(w,) for w in ("cat", "cats", "running", "run", "bakes", "bake", "is")], "token string")
    lemmas = stage(K.derive_lemmas(words))
    assert {r["token"]: r["lemma"] for r in lemmas.collect()} == {"cats": "cat", "bakes": "bake"}
    df = spark.createDataFrame([(1, ["cats", "!", "sing"]), (2, []), (3, None)], "id int, tokens array<string>")
    got = {r["id"]: r["lemmas"] for r in K.lemmatize(df, ["id"], "tokens", lemmas).collect()}
    assert got == {1: ["cat", "sing"], 2: [], 3: None}
    kept = {r["id"]: r["lemmas"] for r in K.lemmatize(df, ["id"], "tokens", lemmas, keep_punctuation=True).collect()}
    assert kept[1] == ["cat", "!", "sing"]


def test_label_join_fans_out(spark):
    from strophe.plans.labels import merge_labels

    left = spark.createDataFrame([(1, 0), (1, 1)], "id int, stanza_number int")
    right = spark.createDataFrame([(1, 0, "x"), (1, 0, "y"), (2, 0, "z")], "id int, stanza_number int, label string")
    assert sorted(map(tuple, merge_labels(left, [right]).collect())) == [(1, 0, "x"), (1, 0, "y")]


def test_sharded_top_equals_plain_top(spark, monkeypatch):
    df = spark.range(5000).select(F.concat(F.lit("t"), "id").alias("term"), (F.col("id") * 7 % 900).alias("cf"))
    plain = sorted(((r.term, r.cf) for r in df.collect()), key=lambda r: (-r[1], r[0]))[:50]
    monkeypatch.setattr(K, "SHARDS", 7)
    assert [(r.term, r.cf) for r in K.top_per_group(df, [], F.col("cf"), 50, rank="r").orderBy("r").collect()] == plain
    renamed = df.withColumnRenamed("term", "word")
    assert K.top_per_group(renamed, [], F.col("cf"), 50, term="word").count() == 50


def test_bag_as_matrix(spark):
    posted = stage(K.postings(docs(spark, "b a a", "c"), "doc", "tokens"))
    bag = K.bag_of_words(posted, "doc", stage(K.dictionary(posted, "doc")))
    assert sorted(map(tuple, K.dense_matrix(bag, "doc").collect())) == [(0, 2, 0), (1, 1, 0), (2, 0, 1)]
    with pytest.raises(ValueError):
        K.dense_matrix(bag, "doc", max_docs=1)


def test_staged_tables_live_in_the_shared_folder(spark):
    from strophe.sources.staging import shared_folder

    table = stage(spark.range(3))
    assert all(shared_folder(spark).split(":")[-1] in f for f in table.inputFiles()) and table.count() == 3


def test_tokens_are_computed_once(spark):
    from strophe.functions.text import analyze

    df = spark.createDataFrame([(1, "some text"), (2, ""), (3, None)], "doc bigint, t string")
    posted = K.postings(df, "doc", analyze(F.col("t")))
    assert posted.count() == 2
    plan = posted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_samples_of_rows_with_several_keys(spark):
    """Stanzas share the id of their song, so rows are told apart by id and number."""
    from strophe.operators.sampling import kfold, not_sampled, random_split, sample_n, train_val_test

    rows = spark.range(1000).select((F.col("id") % 7).alias("id"), F.col("id").alias("stanza_number"), (F.col("id") % 3).alias("label"))
    key = ["id", "stanza_number"]
    taken = sample_n(rows, 10, key)
    assert taken.count() == 10 and not_sampled(rows, taken, key).count() == 990
    assert random_split(rows, 0.3, key).where("split = 'test'").count() == 300
    parts = {(r.label, r.split): r["count"] for r in train_val_test(rows, "label", key).groupBy("label", "split").count().collect()}
    assert parts[(0, "test")] == 101 and parts[(1, "test")] == 100
    with pytest.raises(ValueError):
        sample_n(rows, 10, "id")
    folds = kfold(rows.withColumn("label", F.when(F.col("label") > 0, F.col("label"))), 5, "label", key)
    assert folds.count() == 1000 and folds.where("fold is null").count() == 334


def test_lookup_joins_by_bytes(spark):
    table = spark.createDataFrame([(1, "x" * 100, [1, 2]), (2, None, None)], "key int, text string, list array<int>")
    assert 120 < J.data_bytes(table) < 200


def test_positions(spark):
    values = [None, *range(0, 400, 2), 7, 7, 7]
    df = spark.createDataFrame([(v, f"r{i}", i) for i, v in enumerate(values)], "v int, name string, _slice int").repartition(7)
    order = [F.col("v"), F.col("_slice").desc()]
    want = sorted(((v, f"r{i}", i) for i, v in enumerate(values)), key=lambda r: (r[0] is not None, r[0] or 0, -r[2]))
    placed = Positions.of(df, order, slices=9)
    assert placed.total == len(want)
    for start, stop in [(None, None), (0, 1), (3, 4), (5, 150), (-30, None), (-500, 20), (100, -50), (50, 50), (60, 10), (900, None), (None, 900)]:
        got = placed.between(start, stop, "place")
        assert got.columns == ["v", "name", "_slice", "place"]
        assert sorted(tuple(r) for r in got.select("place", "name").collect()) == [(i, want[i][1]) for i in range(len(want))[start:stop]]
        assert sorted(r.name for r in placed.between(start, stop).collect()) == sorted(r[1] for r in want[start:stop])
    assert sorted(r.name for r in placed.head(4).collect()) == sorted(r[1] for r in want[:4])
    assert sorted(r.name for r in placed.tail(4).collect()) == sorted(r[1] for r in want[-4:])
    assert placed.tail(0).count() == placed.head(0).count() == placed.head(-3).count() == 0
    with pytest.raises(ValueError):
        placed.head(2, "NAME")


def test_positions_read_touched_folders_only(spark):
    placed = Positions.of(spark.range(10_000), ["id"], slices=20)
    part = placed.between(4_000, 5_000)
    plan = part._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line and "before" not in line]
    assert len(scans) == 2 and all("_slice" in line.split("PartitionFilters: [")[1].split("]")[0] for line in scans)
    assert sorted(r.id for r in part.collect()) == list(range(4_000, 5_000))


def test_positions_of_an_empty_table(spark):
    placed = Positions.of(spark.createDataFrame([], "v int"), ["v"])
    assert placed.total == 0 and placed.head(3, "place").collect() == [] and placed.between().count() == 0
