import itertools
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from frames import AWKWARD, LONG, documents, with_clashes
from statutegraph.llm import common, decontam, langid, neardup, queries, simhash

# ---------------------------------------------------------------- SimHash


def brute_fingerprint(text, k=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    sh = [b" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, radius=3):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= radius:
            root[max(find(i), find(j))] = min(find(i), find(j))
    least = defaultdict(list)
    for i, n in enumerate(ids):
        least[find(i)].append(n)
    return [min((n for n in least[find(i)] if n is not None), default=None) for i in range(len(ids))]


@pytest.mark.parametrize("clashing", [False, True])
def test_simhash_equals_brute_force(spark, clashing):
    base = " ".join(f"w{i}" for i in range(400))
    near = [(200 + i, base.replace(f"w{i} ", f"W{i}x ") if i % 2 else base + f" tail{i}") for i in range(12)]
    rows = AWKWARD + near
    got = simhash.simhash_groups(documents(spark, rows, clashing)).select("doc_id", simhash.as_hex(F.col("fp")).alias("f"), "component_id").collect()
    fps = [brute_fingerprint(r[1]) for r in rows]
    want = Counter(zip((r[0] for r in rows), (f"{f:016x}" for f in fps), brute_components([r[0] for r in rows], fps)))
    assert Counter(map(tuple, got)) == want


def test_simhash_of_nothing(spark):
    assert simhash.simhash_groups(documents(spark, [])).count() == 0


@pytest.mark.parametrize(("tile", "blocks"), [(4, None), (4096, None), (64, 6), (4096, 7)])
def test_links_miss_no_pair_whatever_the_tile(spark, tile, blocks):
    rng = np.random.default_rng(4)
    fps = [int(x) for x in rng.integers(0, 1 << 63, 40)] + [0, (1 << 64) - 1]
    for f in list(fps):
        for _ in range(4):
            g = f
            for b in rng.choice(64, rng.integers(1, 6), replace=False):
                g ^= 1 << int(b)
            fps.append(g)
    hot = 0x0F0F << 40
    fps += [hot ^ (1 << a) ^ (1 << b) for a, b in itertools.combinations(range(12), 2)]  # one crowded bucket
    fps = sorted(set(fps))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash.linked(spark.createDataFrame([(f,) for f in signed], "fp long"), tile=tile, blocks=blocks)
    roots = {r.node: r.root for r in simhash.components(links).collect()}
    got = [roots.get(f, f) for f in signed]
    want = brute_components(fps, fps)
    assert all((got[i] == got[j]) == (want[i] == want[j]) for i, j in itertools.combinations(range(len(fps)), 2))


def test_more_fingerprints_get_longer_keys():
    assert [simhash.blocks_for(n, 3) for n in (0, 1000, 1 << 24, 1 << 27, 1 << 36)] == [5, 5, 5, 6, 8]
    for blocks in (5, 6, 8):
        masks = [m & (1 << 64) - 1 for m in simhash.block_masks(3, blocks)]
        for flips in itertools.combinations(range(0, 64, 5), 3):
            assert any(not any(m >> b & 1 for b in flips) for m in masks)


def test_large_groups_leave_a_forest_not_all_pairs(spark):
    fps = [1 << a | 1 << b for a, b in itertools.combinations(range(40), 2)]
    n = simhash.linked(spark.createDataFrame([(f,) for f in fps], "fp long")).count()
    assert n < 10 * len(fps)


def test_components_of_a_chain_a_star_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 164)] + [(7, i) for i in range(8, 40)] + [(5, 5), (90, 91), (91, 90)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 165)} == {100} and {got[i] for i in range(7, 40)} == {7} and got[91] == 90 and 5 not in got


# ---------------------------------------------------------------- near copies of a similarity


def jaccard(a, b):
    s = [frozenset(zip(*(t.split()[i:] for i in range(5)))) for t in (a, b)]
    return len(s[0] & s[1]) / max(1, len(s[0] | s[1]))


def test_near_copies_go_and_others_stay(spark):
    rng = np.random.default_rng(6)
    rows, n = [], 0
    for g in range(15):
        w = [f"g{g}w{rng.integers(500)}" for _ in range(300)]
        rows.append((n, " ".join(w)))
        n += 1
        for _ in range(6):
            v = list(w)
            for i in rng.choice(300, 4, replace=False):
                v[i] = f"other{rng.integers(10_000)}"
            rows.append((n, " ".join(v)))
            n += 1
    got = {r.doc_id: r.component_id for r in neardup.near_groups(documents(spark, rows)).collect()}
    for (i, a), (j, b) in itertools.combinations(rows, 2):
        if jaccard(a, b) >= 0.8:
            assert got[i] == got[j]
        elif i // 7 != j // 7:
            assert got[i] != got[j]
    assert neardup.without_near_duplicates(documents(spark, rows)).count() == 15


@pytest.mark.parametrize("members", [8, 256])
@pytest.mark.parametrize("base_at", [30, 60])
def test_copies_edited_apart_meet_a_base_that_does_not_lead(spark, monkeypatch, base_at, members):
    monkeypatch.setattr(neardup, "MEMBERS", members)
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in range(300)]
    texts = []
    for c in range(60):
        v = list(base)
        for i in rng.choice(300, 5, replace=False):
            v[i] = f"c{c}x{i}"
        texts.append(" ".join(v))
    texts.insert(base_at, " ".join(base))
    rows = list(enumerate(texts))
    got = {r.doc_id: r.component_id for r in neardup.near_groups(documents(spark, rows)).collect()}
    near = [i for i, t in rows if jaccard(t, texts[base_at]) >= 0.8]
    assert len(near) > 50 and {got[i] for i in near} == {got[base_at]}


def test_near_copies_with_a_repeated_line_meet(spark):
    common = [f"w{i}" for i in range(400)]
    rows = [(c, " ".join(common + [f"line{c}x{i}" for i in range(12)] * 60)) for c in range(6)]
    assert all(jaccard(a, b) >= 0.9 for (_, a), (_, b) in itertools.combinations(rows, 2))
    assert {r.component_id for r in neardup.near_groups(documents(spark, rows)).collect()} == {0}


def test_near_copies_keep_columns_and_awkward_rows(spark):
    df = documents(spark, AWKWARD, clashing=True)
    kept = neardup.without_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 10, 2, 4, 7, 9, None]  # 2, 3 and 6 have no word
    assert neardup.without_near_duplicates(documents(spark, [])).count() == 0


# ---------------------------------------------------------------- decontamination

ITEMS = [(1, "one two three four five six seven eight nine ten"), (2, "Too short"), (3, None), (None, "alpha beta gamma delta epsilon zeta"), (5, "one two three four five six seven eight nine ten")]


def brute_contained(docs, items, k=5, share=0.8):
    import regex

    def sh(t):
        w = regex.findall(r"[\p{L}\p{M}\p{N}_]+", (t or "").lower())
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}

    out = []
    for i, t in items:
        s = sh(t)
        for d in docs:
            m = len(s & sh(d[1]))
            if s and m >= share * len(s):
                out.append((d[0], i, m, len(s)))
    return Counter(out)


@pytest.mark.parametrize("clashing", [False, True])
@pytest.mark.parametrize("block", [1 << 20, 30])
def test_contained_items_equal_brute_force(spark, clashing, block):
    item = ITEMS[0][1]
    rows = AWKWARD + [
        (50, f"before, {item}! after"),
        (51, LONG + " «ONE Two three» four\nfive six seven eight nine—ten"),
        (52, "one two three four five six seven eight nine x ten"),
        (53, "one two three x four five six seven eight nine ten"),
        (54, "alpha beta gamma delta epsilon zeta " * 3),
        (55, "one，two→three😀four five。six€seven …eight nine\u3000ten"),
        (56, "oneµtwo three four five six seven²eight nine ten"),
    ]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = documents(spark, rows, clashing)
    got = decontam.contained_items(docs, with_clashes(items) if clashing else items, block_bytes=block)
    assert Counter((r.doc_id, r.item_id, r.matched, r.shingles) for r in got.collect()) == brute_contained(rows, ITEMS)
    clean = decontam.without_contaminated(docs, items, block_bytes=block)
    assert clean.columns == docs.columns and not {50, 51, 52, 54, 55} & {r.doc_id for r in clean.select("doc_id").collect()}
    assert clean.count() == len(rows) - 5


def test_contained_items_of_nothing(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontam.contained_items(documents(spark, AWKWARD), none).count() == 0
    assert decontam.contained_items(documents(spark, []), some).count() == 0


def test_sketch_finds_every_item_at_the_threshold():
    rng = np.random.default_rng(2)
    for _ in range(200):
        n = int(rng.integers(5, 60))
        w = [f"w{i}" for i in range(n)]
        index = decontam.build([(1, " ".join(w))])
        shingles = n - 4
        need = decontam.needed(shingles, 0.8)
        data = " ".join(w[: n - (shingles - need)]).encode()  # holds exactly the needed shingles
        (h,) = common.hashed_texts([data], 5, punctuation=True)
        assert index.matches(h, data) == [(1, need, shingles)]
        (h,) = common.hashed_texts([data.rpartition(b" ")[0]], 5, punctuation=True)
        assert index.matches(h, data) == []


def test_items_of_a_size_meet_only_texts_that_can_hold_them():
    items = [(n, " ".join(f"s{n}w{i}" for i in range(n))) for n in (5, 12, 40, 200, 1500)]
    index = decontam.build(items)
    assert len(index.classes) == 5 and [c.least for c in index.classes] == [decontam.needed(n - 4, 0.8) for n, _ in items]
    for n, text in items:
        (h,) = common.hashed_texts([text.encode()], 5, punctuation=True)
        assert index.matches(h, text.encode()) == [(n, n - 4, n - 4)]
        assert all(not len(c.near(h)) for c in index.classes if c.least > len(h))


WORDS_OF_ALL_KINDS = ["二，三 四、五", "a→b €5 x²", "emoji😀word 😀", "µm naïve e\u0301te\u0301", "々 ー ｱ", "۱۲۳ ½", "a_b-c d\u00a0e\u2028f", "\U00020000\U0001d7ce", "", "don’t «so»", "ქართული ไทย हिन्दी"]


@pytest.mark.parametrize("text", [*WORDS_OF_ALL_KINDS, " ".join(WORDS_OF_ALL_KINDS)])
def test_words_are_runs_of_letters_marks_and_digits(text):
    import regex

    data = text.encode()
    starts, ends = common.word_spans(np.frombuffer(data, dtype=np.uint8), punctuation=True)
    assert [data[a:b].decode() for a, b in zip(starts, ends)] == regex.findall(r"[\p{L}\p{M}\p{N}_]+", text)


# ---------------------------------------------------------------- language


def test_languages_of_held_out_documents(spark, sf_dir):
    rows = queries.op9_langid(spark, sf_dir).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in docs if zlib.crc32(str(i).encode()) % 4 == 2}
    right = sum(r.lang_pred == docs[r.doc_id].lang for r in held)
    assert right >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_awkward_rows(spark):
    rows = AWKWARD + [(100 + i, f"the quick brown fox number {i}", "en") for i in range(40)] + [(200 + i, f"der schnelle braune Fuchs Nummer {i}", "de") for i in range(40)]
    df = documents(spark, rows, clashing=True)
    got = langid.identify(df, langid.fit(df)).collect()
    by = {r.doc_id: r.lang_pred for r in got}
    assert len(got) == len(rows)
    assert by[2] == by[3] == by[6] == by[10] == "und" and by[7] != "und"
    assert by[105] == "en" and by[205] == "de" and by[4] in ("en", "fr", "de")


def test_no_labels_and_one_label(spark):
    none = documents(spark, [(1, "some text", None), (2, None, None)])
    assert {r.lang_pred for r in langid.identify(none, langid.fit(none)).collect()} == {"und"}
    one = documents(spark, [(i, f"some text {i}", "en") for i in range(8)])
    assert {r.lang_pred for r in langid.identify(one, langid.fit(one)).collect()} == {"en"}
    empty = documents(spark, [])
    assert langid.identify(empty, langid.fit(empty)).count() == 0


@pytest.mark.parametrize("n", [2, 3, 4, 6, 9, 40])
def test_codewords_differ(n):
    code = langid.codewords(n)
    near = min((code[i] != code[j]).sum() for i, j in itertools.combinations(range(n), 2))
    assert code.shape[0] == n and near >= (1 if n < 4 else 3)


def test_counts_do_not_depend_on_the_cut(monkeypatch):
    text = "Größe déjà vu " * 300
    whole = langid.ngram_counts(text)
    monkeypatch.setattr(langid, "CHUNK", 7)
    assert np.allclose(whole, langid.ngram_counts(text))


def test_decoding_equals_a_plain_loop():
    """Margins, losses weighted by reliability and the nearest codeword, recomputed number by number."""
    import math

    texts = [(f"the cat number {i} sat", "en") for i in range(9)] + [(f"le chat numéro {i} est", "fr") for i in range(9)] + [(f"die Katze Nummer {i} ist", "de") for i in range(9)]
    langs = ["de", "en", "fr"]
    model = langid.train(langs, np.array([langid.ngram_counts(t) for t, _ in texts]), np.array([langs.index(x) for _, x in texts]))
    for text in ("the dog", "un chien est ici", "Hund", "xyz"):
        x = langid.ngram_counts(text)
        margins = [sum(float(a) * float(b) for a, b in zip(x, model.weights[:-1, k]) if a) + float(model.weights[-1, k]) for k in range(model.code.shape[1])]
        losses = [sum(float(r) * max(0.0, 1.0 - float(c) * m) for r, c, m in zip(model.reliable, word, margins)) for word in model.code]
        lang, score, ambiguous, loss = model.predict(text)
        shares = [math.exp(4 * (min(losses) - v)) for v in losses]
        assert lang == langs[losses.index(min(losses))] and math.isclose(loss, min(losses), abs_tol=1e-9)
        assert math.isclose(score, max(shares) / sum(shares), abs_tol=1e-9)
        top = sorted(shares)[::-1]
        assert ambiguous == ((top[0] - top[1]) / sum(shares) < langid.AMBIGUOUS)


def test_rows_beyond_features_give_the_same_weights(monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(langid, "FEATURES", 12)
    x, y = rng.random((30, 12)), np.arange(30) % 3
    primal = langid.train(["a", "b", "c"], x, y)
    wide = langid.train(["a", "b", "c"], np.hstack([x, np.zeros((30, 40))]), y)  # more features than rows: solved by the dual
    assert np.allclose(primal.weights[:-1], wide.weights[:12]) and np.allclose(primal.weights[-1], wide.weights[-1])


def test_texts_against_every_codeword_go_and_labelled_ones_stay(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.fit(docs)
    import regex

    letters = {r.doc_id for r in docs.collect() if r.text and regex.search(r"\p{L}", r.text)}
    assert {r.doc_id for r in langid.in_a_language(docs, model).collect()} == letters
    far = langid.Model(model.languages, model.code, -model.weights, model.reliable)  # says the opposite of what it knows
    assert langid.in_a_language(docs, far).count() < len(letters)


def test_the_sample_is_bounded_over_all_languages(spark):
    rows = [(i, f"wort{i % 50} text{i} lang{i % 10}", f"l{i % 10}") for i in range(2000)]
    seen = []
    real = langid.train
    langid.train = lambda languages, x, y: seen.append(len(x)) or real(languages, x, y)
    try:
        langid.fit(documents(spark, rows), train_total=300)
    finally:
        langid.train = real
    assert 200 < seen[0] < 420


def test_sample_is_bounded_whatever_the_ids_and_labels(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(langid, "train", lambda languages, x, y: seen.append((len(languages), len(x))) or langid.Model(languages, np.ones((len(languages), 1)), np.zeros((1, 1)), np.ones(1)))
    same_id = [(3, f"the cat number {i} sat", "en") for i in range(5000)] + [(3, "the same cat sat", "en")] * 5000
    langid.fit(documents(spark, same_id).repartition(7))
    langid.fit(documents(spark, [(None, t, x) for _, t, x in same_id]).repartition(7))
    langid.fit(documents(spark, [(i, f"text {i}", f"label{i % 9000 if i % 2 else i % 5}") for i in range(12_000)]), most_languages=30)
    assert all(n == 1 and 100 < rows <= langid.TRAIN_DOCS for n, rows in seen[:2])
    assert seen[2][0] == 30 and seen[2][1] <= 30 * langid.TRAIN_DOCS


def test_ids_may_be_strings(spark):
    rows = [(f"doc-{i}", *DISTINCT_WORDS[i % 2]) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, lang string")
    got = langid.identify(docs, langid.fit(docs)).collect()
    assert {(r.lang_pred, int(r.doc_id[4:]) % 2) for r in got} == {("en", 0), ("de", 1)}
    items = spark.createDataFrame([("item-a", "one two three four five six seven")], "item_id string, text string")
    found = spark.createDataFrame([("x", "zero one two three four five six seven eight"), ("y", "nothing here")], "doc_id string, text string")
    assert [(r.doc_id, r.item_id) for r in decontam.contained_items(found, items).collect()] == [("x", "item-a")]
    assert [r.doc_id for r in decontam.without_contaminated(found, items).collect()] == ["y"]


DISTINCT_WORDS = [("the quick brown fox jumps over the lazy dog", "en"), ("der schnelle braune Fuchs springt über den faulen Hund", "de")]
