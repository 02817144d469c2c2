"""The operators on small literal tables against brute force, round trips and held-out accuracy."""

import gzip
import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("foliar.llm")

from pyspark.sql import functions as F  # noqa: E402

from foliar import session  # noqa: E402
from foliar.llm import _jobs, decontaminate, html_text, language_id, line_dedup, minhash_dedup, mixing, quality_rules, suffix_dedup, toxicity, warc  # noqa: E402
from foliar.llm._jobs import among, groups, labelled_sample, link_buckets  # noqa: E402
from foliar.session import scratch_path  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, name int"
WORD = re.compile("[^\x20\x09-\x0d]+")


def docs_of(spark, texts, ids=None, langs=None):
    ids = range(len(texts)) if ids is None else ids
    langs = ["en"] * len(texts) if langs is None else langs
    rows = [(i, t, g, "src0", len(t or ""), "clash", 7) for i, t, g in zip(ids, texts, langs)]
    return spark.createDataFrame(rows, SCHEMA)


def prose(seed, n, words=400):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abdeghilmnorstuvw") for _ in range(rng.randint(2, 9))) for _ in range(words)]
    return " ".join(rng.choice(pool) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    base = prose(1, 150)
    shared = prose(2, 90)
    near = [" ".join(w if i != k * 7 else f"other{k}" for i, w in enumerate(base.split())) for k in range(12)]
    texts = [base, base, *near, prose(3, 60) + "\n" + shared + "\n" + prose(4, 30), shared + " tail", "x " + shared, prose(5, 900)]
    texts += ["", None, " \t\n", "a", "a", "two words", "Two WORDS", "aaaa" * 300, "é" * 500, "ab" * 700, prose(6, 30) + "\x0b" + prose(7, 20)]
    return texts


def brute_repeats(texts, width):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + width] for b in data for i in range(len(b) - width + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b) + 2, bool)
        for i in range(len(b) - width + 1):
            if seen[b[i : i + width]] > 1:
                gone[i + 1 : i + width + 1] = True
        kept = bytes(x for x, g in zip(b, gone[1:-1]) if not g)
        out.append((len(b), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def test_repeats_equal_brute_force(spark, corpus):
    got = suffix_dedup.digest(suffix_dedup.remove_repeats(docs_of(spark, corpus))).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == dict(enumerate(brute_repeats(corpus, 400)))


def test_repeats_show_what_is_left_and_what_went(spark):
    text = prose(1, 120)
    texts = [text, "ä" + text + "é", "short", None]
    got = {r.doc_id: r for r in suffix_dedup.digest(suffix_dedup.remove_repeats(docs_of(spark, texts)), detail=True).collect()}
    n = len(text.encode())
    assert (got[0].kept_text, got[0].removed_spans) == ("", f"0:{n}") and (got[1].kept_text, got[1].removed_spans) == ("äé", f"2:{n + 2}")
    assert (got[2].kept_text, got[2].removed_spans) == ("short", "") and (got[3].kept_text, got[3].removed_spans) == ("", "")


def test_repeats_with_ids_missing_or_repeated(spark):
    texts = [prose(1, 120), prose(1, 120), "short", None]
    got = suffix_dedup.digest(suffix_dedup.remove_repeats(docs_of(spark, texts, ids=[5, 5, None, None]))).collect()
    assert sorted(r.n_removed for r in got) == [0, 0, len(texts[0].encode()), len(texts[0].encode())]


def test_repeats_in_pieces_of_a_long_text(spark, monkeypatch):
    text = prose(9, 3000, words=5000)
    text = text + text[1000:3500] + "x"
    monkeypatch.setattr(suffix_dedup, "PIECE", 2048)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text.encode()])], names=["row", "text"])
    low_high = [(r["low"], r["high"]) for b in suffix_dedup._parse(400)(iter([batch])) for r in b.to_pylist()]
    starts = [x for a, b in low_high for x in range(a, b + 1)]
    assert sorted(starts) == list(range(len(text.encode()) - 399))


def brute_sets(texts):
    out = []
    for t in texts:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        out.append(set(zip(*[w[i:] for i in range(5)])) if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def test_near_duplicates_equal_brute_force(spark, corpus):
    sets = brute_sets(corpus)
    root = list(range(len(sets)))
    for _ in sets:
        for a in range(len(sets)):
            for b in range(len(sets)):
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    got = {r.doc_id: tuple(r)[1:] for r in minhash_dedup.near_duplicates(docs_of(spark, corpus)).collect()}
    assert got == {i: (len(s), root[i], root[i] == i) for i, s in enumerate(sets)}


def test_super_minhash_is_a_permutation_and_estimates():
    rng = np.random.default_rng(1)
    a, b = rng.integers(1, 2**63, 400, dtype=np.uint64), rng.integers(1, 2**63, 100, dtype=np.uint64)
    sig = minhash_dedup.super_minhash(np.concatenate([a, a[100:], b, a[:1]]), np.repeat([0, 1, 2], [400, 400, 1]), 4)
    assert abs(np.mean(sig[0] == sig[1]) - 300 / 500) < 0.12
    assert sorted(np.floor(sig[2])) == list(range(minhash_dedup.SLOTS))  # one shingle reaches every slot at its own rank
    assert np.isinf(sig[3]).all()


def test_groups_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(1, 300)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    random.Random(3).shuffle(chain)
    links = spark.createDataFrame(chain + star, "a long, b long").repartition(7)
    got = {r.node: r.root for r in groups(links).collect()}
    assert got == {**{i: 1 for i in range(1, 301)}, **{1000 + i: 1000 for i in range(200)}}
    assert groups(links.where("a < 0")).count() == 0


def test_lines(spark):
    long = "The tugs could not leave the harbour before noon because of the ice on pier %s and the wind"
    texts = [f"{long % 1}\nUnique one here.\nok", f"{(long % 2).upper()}!\nok\nAnother unique line", "ok", None, "", f"{long % 1}"]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(docs_of(spark, texts)).collect()}
    assert got[0] == (texts[0], 3, 0)
    assert got[1] == ("ok\nAnother unique line", 3, 1)
    assert got[2] == ("ok", 1, 0) and got[3] == (None, 0, 0) and got[4] == ("", 1, 0) and got[5] == ("", 1, 1)


def test_block_keys_find_all_within_the_radius():
    rng = random.Random(4)
    a = [rng.getrandbits(64) for _ in range(300)]
    b = [x ^ sum(1 << i for i in rng.sample(range(64), 3)) for x in a]
    left, right = line_dedup.block_keys(np.array(a, np.uint64)), line_dedup.block_keys(np.array(b, np.uint64))
    assert all(set(x) & set(y) for x, y in zip(left.tolist(), right.tolist()))


def test_edit_distance():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
        return row[-1]

    rng = random.Random(5)
    for _ in range(300):
        a = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 90)))
        b = "".join(c for c in a if rng.random() > 0.2) + rng.choice(["", "x", "abca"])
        assert line_dedup.edit_distance(a, b) == plain(a, b)


def test_text_counts_equal_brute_force(spark, corpus):
    texts = [*corpus, "a b c d e f g h " * 4, "x #1 $% <a>\nx #1 $% <a>\n\n \nY", "ü ö\nü ö"]
    got = {r.doc_id: r for r in quality_rules.text_counts(docs_of(spark, texts)).collect()}
    for i, t in enumerate(texts):
        t = t or ""
        w = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        windows = Counter(tuple(w[j : j + 8]) for j in range(len(w) - 7))
        covered = {j + k for j in range(len(w) - 7) if windows[tuple(w[j : j + 8])] > 1 for k in range(8)}
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, t


def test_decision_list_learns_and_is_ordered(spark):
    rng = random.Random(6)
    good = [prose(100 + i, rng.randint(30, 60)) for i in range(60)]
    bad = [" ".join(w.upper() + "!!" for w in prose(200 + i, 40).split()) for i in range(40)]
    docs = docs_of(spark, good + bad + [None, ""])
    labels = spark.createDataFrame([(i, 1 if i < 60 else 0) for i in range(100)], "doc_id long, quality int")
    counts = quality_rules.text_counts(docs)
    rules = quality_rules.fit(counts, labels)
    kept = {r.doc_id: (r.kept, r.base_failed) for r in quality_rules.judge(counts, rules).collect()}
    assert rules and all(kept[i][0] for i in range(60)) and not any(kept[i][0] for i in range(60, 100))
    assert kept[100] == (False, True) and kept[101] == (False, True)
    assert quality_rules.fit(counts, labels.where("quality = 1")) == []
    assert quality_rules.fit(counts, labels.where("false")) == []


def test_html(spark):
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><nav><a href=1>Home</a></nav><div class='ad'>Buy now</div>"
        "<article><h1>Head &amp; line</h1><p>First  <b>bold</b>\n text.<p>Second&nbsp;one</p><script>x('</p>')</script><!-- no --></article>"
        "<div id='comments'><p>Nice</p></div><footer>&copy; me</footer></body></html>"
    )
    rows = [(1, "u", page, "c"), (2, None, None, "c"), (3, "u", "", "c"), (4, "u", "<article><p>cut", "c")]
    got = {r.page_id: (r.text, r.n_chars) for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()}
    want = "Head & line\n\nFirst bold text.\n\nSecond one"
    assert got == {1: (want, len(want)), 2: ("", 0), 3: ("", 0), 4: ("cut", 3)}
    x, y = html_text.labelled_table()
    tree = html_text.grow(x, y)
    assert np.mean([html_text.is_main(tree, list(f)) == t for f, t in zip(x, y)]) > 0.9


@pytest.mark.parametrize(
    "page, want",
    [
        ("<article><p title=don't>It's fine. Don't go.</p><p>More</p></article>", "It's fine. Don't go.\n\nMore"),
        ('<article class="post tags news"><p>Hello there.</p></article>', "Hello there."),
        ('<div class="wrap search"><article><p>Hello.</p></article></div>', "Hello."),
        ("<form id=aspnetForm><article><p>Hello.</p></article></form>", "Hello."),
        ('<div class="has-sidebar"><article><p>Hello.</p></article></div>', "Hello."),
        ('<article><p class="x>Hello there <b class="y">bold</b></p></article>', "Hello there bold"),
        ('<article><p title="a > b" class="c">Hello.</p></article>', "Hello."),
        ("<article><p>Text here.</p><h3>Comments (2)</h3><p>Nice one</p></article>", "Text here."),
        ("<article><div><h4>Replies</h4><p>Nice one</p></div><p>Text here.</p></article>", "Text here."),
        ("<article><p>Text.</p><div class='user-notes'><p>Me too</p></div></article>", "Text."),
        ("<article><p>Text.</p></article><section id=comments><article class=comment><p>Me too</p></article></section>", "Text."),
        ("<article><p>a < b and c <d", "a < b and c <d"),
        ("<article><p>One.</p><button>Send<p>Two.</p></article>", "One.\n\nSend\n\nTwo."),
        ("<article><p>One.</p><script>never closed <p>Two.</p></article>", "One."),
    ],
)
def test_html_of_odd_markup(page, want):
    assert html_text.main_text(page, html_text.grow(*html_text.labelled_table())) == want


def test_html_tree_asks_the_neighbours():
    pages = html_text.unnamed_pages()
    x, y = html_text.labelled_table(html_text.LABELLED + html_text.named_pages() + pages[::2])
    tree = html_text.grow(x, y)

    def asked(t):
        return set() if isinstance(t, bool) else {t[0]} | asked(t[2]) | asked(t[3])

    assert asked(tree) & {2, 4} and asked(html_text.grow(*html_text.labelled_table())) & {2, 4}
    # Pages it was not grown from; without its neighbours' features it does worse.
    hx, hy = html_text.labelled_table(pages[1::2])
    right = np.mean([html_text.is_main(tree, list(f)) == t for f, t in zip(hx, hy)])
    alone = [0, 1, 6, 7, 8, 9]
    blind = html_text.grow(x[:, alone], y)
    assert right > 0.95 and right > np.mean([html_text.is_main(blind, list(f)) == t for f, t in zip(hx[:, alone], hy)])


@pytest.mark.parametrize("piece", ["<a ", "<div>", "<p x='", "<!--", '<p x="a>', "<svg>", "<button><select>", "< "])
def test_html_of_very_long_broken_pages(piece):
    tree = html_text.grow(*html_text.labelled_table())
    start = time.process_time()
    html_text.main_text(piece * (1_000_000 // len(piece)), tree)
    assert time.process_time() - start < 10


def test_html_of_unmatched_ends_over_a_deep_stack():
    start = time.process_time()
    assert [t for t, _ in html_text.text_blocks("<div>" * 40_000 + "x" + "</section>" * 40_000)] == ["x"]
    assert time.process_time() - start < 10


def test_html_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string, text long")
    assert html_text.extract(empty).collect() == []


def test_html_with_ends_left_out():
    page = "<head><title>T</title><body><article><p class=notice>Mind the gap.<p>Some words of the text.<ul><li class=share>Send it<li>First item</ul></article>"
    assert [(text, f[6]) for text, f in html_text.text_blocks(page)] == [("Mind the gap.", 1.0), ("Some words of the text.", 0.0), ("Send it", 1.0), ("First item", 0.0)]


def test_labelled_sample_is_bounded(spark):
    docs = spark.range(3000).selectExpr("id", "concat('text ', id) text").unionByName(spark.createDataFrame([(None, "x")], "id long, text string"))
    labels = spark.range(1000, 4000).selectExpr("id", "1 quality")
    assert labelled_sample(docs, labels, 2000).count() == 2000
    part = {r.id for r in labelled_sample(docs, labels, 400).collect()}
    assert 200 <= len(part) <= 400 and part <= set(range(1000, 3000))
    assert part == {r.id for r in labelled_sample(docs.repartition(7), labels, 400).collect()}
    assert labelled_sample(docs, labels.where("false"), 400).count() == 0


def test_mixing_meets_targets(spark):
    rng = random.Random(7)
    pools = {"en": "the of and ice harbour tug".split(), "de": "der und von eis hafen das".split()}
    langs = ["en" if i % 4 else "de" for i in range(200)]
    texts = [" ".join(rng.choice(pools[g]) for _ in range(rng.randint(20, 60))) for g in langs]
    docs = docs_of(spark, [*texts, None, ""], langs=[*langs, None, "en"])
    labelled = docs.where("doc_id < 80").select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("domain"))
    _, rates, domains = mixing.mix(docs, labelled, {"en": 0.4, "de": 0.4, "fr": 0.2})
    rows = rates.collect()
    assert domains == ["de", "en"] and len(rows) == 202 and all(r.rate >= 0 for r in rows)
    total = sum(r.tokens for r in rows)
    for i in (0, 1):
        assert abs(sum(r.rate * r.tokens * r.p[i] for r in rows) - total / 2) < 0.01 * total
    _, plain, none = mixing.mix(docs, labelled.where("false"), {"en": 1.0})
    assert none == [] and {r.rate for r in plain.collect()} == {1.0}


def test_rates_never_fall_below_zero(spark):
    members = spark.createDataFrame([(100, [1.0, 0.0]), (50, [0.5, 0.5]), (10, [0.0, 1.0])], "tokens long, p array<double>")
    steps = mixing.fit_rates(members, [0.0, 60.0], steps=40)
    rows = members.withColumn("rate", mixing.rate(steps)).collect()
    assert min(r.rate for r in rows) == 0.0 and rows[2].rate > 1


def test_language(spark):
    rng = random.Random(8)
    pools = {g: [prose(k * 1000 + i, 1) for i in range(80)] for k, g in enumerate(("de", "en", "fr"), 30)}
    langs = [("de", "en", "fr")[i % 3] for i in range(90)]
    texts = [" ".join(rng.choice(pools[g]) for _ in range(30)) for g in langs]
    docs = docs_of(spark, [*texts, None, "123 !", ""], langs=[*langs, "en", "en", None])
    samples = language_id.dictionaries(docs.where("doc_id < 45").select(F.col("doc_id").alias("id"), "text", "lang"))
    got = {r.doc_id: r for r in language_id.identify(docs, samples).collect()}
    assert np.mean([got[i].lang_pred == langs[i] for i in range(45, 90)]) > 0.95
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (90, 91, 92)) and all(0 <= r.score <= 1 for r in got.values())
    assert {r.lang_pred for r in language_id.identify(docs, {}).collect()} == {"und"}


def test_language_of_long_texts_only_and_of_a_hot_id(spark):
    words = {"a": ["tul", "mek", "oro", "vasti"], "b": ["shin", "quax", "ply", "wredge"], "c": ["jo", "ii", "zzem", "fao"]}
    rng = random.Random(3)
    text = lambda lang, n: " ".join(rng.choices(words[lang], k=n))
    # One language has long texts only, one a single hot row, one rows without an id.
    rows = [(i, text("a", 3000), "a") for i in range(5)] + [(9, "shin quax ply wredge quax shin", "b")] * 500 + [(None, text("c", 30), "c") for _ in range(400)]
    samples = language_id.dictionaries(spark.createDataFrame(rows, "id long, text string, lang string"), sample_rows=50, dictionary_bytes=8 << 10)
    assert sorted(samples) == ["a", "b", "c"] and all(0 < len(s) <= (8 << 10) + 50 for s in samples.values())
    assert samples["b"] == b"shin quax ply wredge quax shin" and samples["c"].count(b"\n") < 50
    docs = spark.createDataFrame([(i, text(lang, 40), lang) for i, lang in enumerate("abc" * 10)], "doc_id long, text string, want string")
    got = {r.doc_id: r.lang_pred for r in language_id.identify(docs, samples).collect()}
    assert got == {r.doc_id: r.want for r in docs.collect()}
    # Texts that compress alike everywhere go to the first language; an empty table gives no rows.
    same = language_id.identify(docs, {"x": b"abc", "y": b"abc"}).collect()
    assert {r.lang_pred for r in same} == {"x"} and all(r.rejected for r in same)
    assert language_id.identify(docs.limit(0), samples).collect() == []


def test_labelled_sample_of_a_hot_id(spark):
    rows = spark.range(1000).select((F.col("id") % 2 * F.col("id")).alias("id"), F.col("id").cast("string").alias("text"))
    got = labelled_sample(rows, spark.range(1000).select("id", F.lit(1).alias("y")), 2000).collect()
    assert len(got) == 501 and [r.text for r in got if r.id == 0] == ["0"]


def test_archive_paths_resolve_as_sparks_do(spark, tmp_path):
    assert warc.qualified(spark, str(tmp_path)) == warc.qualified(spark, f"file:{tmp_path}") == f"file://{tmp_path}"


def test_toxicity(spark):
    rng = random.Random(9)
    texts, toxic = [], []
    for i in range(400):
        words = prose(i % 50, 40).split()
        if i % 4 == 0:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["vileword", "badterm", "nastyone"]))
        texts.append(" ".join(words))
        toxic.append(int(i % 4 == 0))
    docs = docs_of(spark, [*texts, None, ""])
    labelled = docs.where("doc_id < 300").join(spark.createDataFrame([(i, t) for i, t in enumerate(toxic)], "doc_id long, toxic int"), "doc_id").select(F.col("doc_id").alias("id"), "text", "toxic")
    got = {r.doc_id: r.score for r in toxicity.score(docs, *toxicity.fit(labelled)).collect()}
    assert all(0 <= s <= 1 for s in got.values()) and len(got) == 402
    assert np.mean([(got[i] >= 0.3) == bool(toxic[i]) for i in range(300, 400)]) > 0.95
    only = toxicity.score(docs, *toxicity.fit(labelled.where("toxic = 0")))
    assert {r.score for r in only.collect()} == {0.0}
    x, y = toxicity.isotonic(np.array([1.0, 2, 3, 3, 4]), np.array([0.0, 1, 0, 1, 1]))
    assert (np.diff(y) >= 0).all() and (np.diff(x) >= 0).all()


def test_warc_round_trip(spark):
    big = "<p>" + "é" * 700
    pages = [(1, "http://a\r\nX: y", big, 1), (2, "u", big, 1), (3, None, None, 1), (4, "u", "small", 1), (5, "u", "small", 1), (6, "u", "", 1), (2, "u", big, 1)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, payload int")
    got = sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(spark, df).collect())
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    want = sorted((str(i), len((t or "").encode()), sha(t), "revisit" if i == 1 else "response", "2" if i == 1 else None) for i, _, t, _ in pages)
    assert got == want
    assert warc.round_trip(spark, df.where("false")).count() == 0


def test_warc_normal_form(spark):
    raw, whole = "file://" + scratch_path(spark, "a").removeprefix("file://"), "file://" + scratch_path(spark, "b").removeprefix("file://")
    df = spark.range(50).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat(F.lit("page "), F.col("id").cast("string")).alias("html")).coalesce(1)
    manifest = warc.write_archives(df, raw, roll=4000)
    names = [r.file for r in manifest.collect()]
    assert len(names) > 1
    warc.normalise(manifest, raw, whole).collect()
    for name in names:
        one, many = open(f"{raw[7:]}/{name}", "rb").read(), open(f"{whole[7:]}/{name}", "rb").read()
        assert gzip.decompress(one) == gzip.decompress(many)
        lines = open(f"{whole[7:]}/{name}.index").read().splitlines()
        assert many.count(b"\x1f\x8b\x08") >= len(lines) > 1
    with pytest.raises(ValueError):
        list(warc.split_records(iter([b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"])))


def brute_contaminated(texts, items):
    out = {}
    split = lambda t: [w for w in re.split("[ \t\n\x0b\f\r]+", (t or "").lower()) if w]
    for item, text in items:
        iw = split(text)
        if not iw:
            continue
        n, k = len(iw), min(5, len(iw))
        counts = Counter(tuple(iw[i : i + k]) for i in range(n - k + 1))
        for d, t in enumerate(texts):
            w = split(t)
            for s in range(len(w) - n + 1):
                own = Counter(tuple(w[s + i : s + i + k]) for i in range(n - k + 1))
                m = sum((own & counts).values())
                sim = m / (2 * (n - k + 1) - m)
                if sim >= 0.75 and sim > out.get((d, item), (0, 0))[1]:
                    out[d, item] = (s, sim)
    return out


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_contamination_equals_brute_force(spark, limit):
    long, mid = prose(11, 50, 5000), prose(12, 20, 5000)
    items = [(1, long), (2, mid), (3, "three little words"), (4, None), (5, ""), (6, "x x x x x x x x")]
    edited = " ".join("changed" if i in (0, 49) else w for i, w in enumerate(long.split()))
    texts = [
        prose(13, 80) + " " + long.upper() + " end", "so " + edited + " so", mid + "\n" + long, long[:150], "the Three  little\twords here", None, "", "x " * 30, mid.rsplit(" ", 1)[0],
        " ".join("changed" if i == 9 else w for i, w in enumerate(mid.split())),
    ]
    benchmark = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, row int")
    found = decontaminate.contaminated(docs_of(spark, texts), benchmark, broadcast_limit=limit).collect()
    got = {(r.doc_id, r.item_id): (r.start_word, round(r.similarity, 9)) for r in found}
    assert got == {k: (s, round(v, 9)) for k, (s, v) in brute_contaminated(texts, items).items()}


def test_native_plans_run_no_python(spark, corpus):
    docs = docs_of(spark, corpus)
    benchmark = spark.createDataFrame([(1, corpus[0])], "item_id long, text string")
    frames = [decontaminate.contaminated(docs, benchmark), mixing.posteriors(docs.select(F.col("doc_id").alias("row"), "text"), *mixing.classifier(docs.select(F.col("doc_id").alias("id"), "text", F.col("lang").alias("domain"))))]
    for df in frames:
        text = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", text)


def test_empty_tables(spark):
    docs = docs_of(spark, ["x"]).where("false")
    benchmark = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert suffix_dedup.remove_repeats(docs).count() == 0
    assert minhash_dedup.near_duplicates(docs).count() == 0
    assert line_dedup.dedup_lines(docs).count() == 0
    assert quality_rules.text_counts(docs).count() == 0
    assert decontaminate.contaminated(docs, benchmark).count() == 0
    assert decontaminate.contaminated(docs_of(spark, ["a b c"]), benchmark.where("false")).count() == 0
    assert language_id.dictionaries(docs.select(F.col("doc_id").alias("id"), "text", "lang")) == {}


def test_near_lines_of_all_lengths_are_found(spark):
    """Against brute-force edit similarity: lines of 2 to 80 words with one letter, one word or a tenth of the characters edited."""
    rng = random.Random(11)
    for words in (2, 3, 4, 5, 8, 12, 20, 40, 80):
        missed = pairs = 0
        for i in range(120):
            line = prose(1000 * words + i, words)
            kind, at = i % 3, rng.randrange(len(line))
            if kind == 0:
                other = line[:at] + "x" + line[at + 1 :]
            elif kind == 1:
                cut = line.split(" ")
                cut[rng.randrange(words)] = "other"
                other = " ".join(cut)
            else:
                spots = set(rng.sample(range(len(line)), len(line) // 10))
                other = "".join(rng.choice(["", "x", "y" + c]) if k in spots else c for k, c in enumerate(line))
            a, b = line_dedup.normal_form(line), line_dedup.normal_form(other)
            if min(len(a), len(b)) < line_dedup.MIN_CHARS or 10 * line_dedup.edit_distance(a, b) > max(len(a), len(b)):
                continue
            keys, owner = line_dedup.gram_keys([a, b])
            bins = np.abs(np.diff(line_dedup.bags([a, b]).view(np.uint8).astype(int), axis=0)).sum()
            found = set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist())
            pairs += 1
            missed += not (found and bins <= 2 * (max(len(a), len(b)) // 10) and line_dedup.similar(a, b))
            assert len(a) >= 60 or not missed, (a, b)
        assert pairs and missed <= 2, (words, missed, pairs)
    texts = [prose(50 + n, n) + "\n" + prose(90 + n, 30) for n in (3, 6, 10, 25, 60)]
    texts += ["".join("z" if i == len(t.split("\n")[0]) // 2 else c for i, c in enumerate(t.split("\n")[0])) for t in texts]
    got = {r.doc_id: (r.n_lines, r.n_removed) for r in line_dedup.dedup_lines(docs_of(spark, texts)).collect()}
    assert got == {i: (2, 0) if i < 5 else (1, 1) for i in range(10)}


def test_benchmark_item_of_more_words_than_a_lane_holds(spark):
    rare = prose(71, 7000, words=5000).split()
    item = ["a"] * 29_420 + rare
    text = ["a"] * 28_900 + prose(72, 520).split() + rare
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = decontaminate.contaminated(docs_of(spark, [" ".join(text), prose(73, 50)]), items).collect()
    assert [(r.doc_id, r.item_id, r.start_word, r.n_words) for r in got] == [(0, 1, 0, 36_420)] and got[0].similarity > 0.97


def test_near_duplicates_of_every_text_of_a_repeated_id(spark):
    first, second, third = prose(81, 120), prose(82, 120), prose(83, 120)
    texts = [first, second, first + " end", second + " end", third, third + " end", first]
    ids = [5, 5, 7, 3, 9, None, None]
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(docs_of(spark, texts, ids)).collect()), key=str)
    assert got == sorted([(5, 3, False), (5, 3, False), (7, 3, False), (3, 3, True), (9, 9, True), (None, None, True), (None, None, True)], key=str)


def test_edit_distance_with_a_bound():
    rng = random.Random(8)
    for _ in range(300):
        a = "".join(rng.choices("abc ", k=rng.randint(0, 40)))
        b = "".join(c for c in a if rng.random() < 0.9) + "".join(rng.choices("abc ", k=rng.randint(0, 4)))
        true = line_dedup.edit_distance(a, b)
        for most in (0, 2, 5, 50):
            got = line_dedup.edit_distance(a, b, most)
            assert got == true if true <= most else got > most


def test_recall_of_line_keys():
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijklmnoprstu", k=rng.randint(2, 9))) for _ in range(4000)]
    for chars in (70, 150, 400):
        found = total = 0
        for _ in range(300):
            line = " ".join(rng.choices(words, k=chars // 4))[:chars].strip()
            other = list(line)
            for i in rng.sample(range(len(line)), len(line) // 10):
                other[i] = rng.choice("abcdefghijklmnoprstu")
            other = "".join(other)
            if line_dedup.similar(line, other):
                keys, owner = line_dedup.gram_keys([line, other])
                total += 1
                found += bool(set(keys[owner == 0]) & set(keys[owner == 1]))
        assert total > 250 and found >= 0.9 * total


def test_lines_with_a_common_passage_elsewhere_are_not_compared(spark):
    def pairs_of(spots):
        seen = []

        def verify(pairs):
            seen.append(sorted(tuple(r) for r in pairs.collect()))
            return pairs.where("false")

        rows = [(i, [(1, spot)], (300, 0, 0, 0, 0)) for i, spot in enumerate(spots)]
        facts = spark.createDataFrame(rows, "node long, keys array<struct<key:long,spot:int>>, sketch struct<chars:int,b0:long,b1:long,b2:long,b3:long>")
        link_buckets(facts, line_dedup.alike, verify, line_dedup.near)
        return seen[1]

    assert pairs_of([0, 100, 200, 300]) == []
    assert pairs_of([0, 30, 61]) == [(0, 1)]
    assert pairs_of([0, line_dedup.ANYWHERE, 200]) == [(0, 1), (1, 2)]


def test_places_of_line_keys():
    line = prose(91, 30)
    keys, owner, spots = line_dedup.placed_keys([line, "abcdefghij" * 4])
    again, _, moved = line_dedup.placed_keys(["qqqqqqqqqq " + line])
    place = dict(zip(keys[owner == 0].tolist(), spots[owner == 0].tolist()))
    shared = [(place[k], m) for k, m in zip(again.tolist(), moved.tolist()) if k in place]
    assert shared and all(m == p + 11 for p, m in shared)
    assert (spots[owner == 1] == line_dedup.ANYWHERE).any() and len(keys) == len(line_dedup.gram_keys([line, "abcdefghij" * 4])[0])


def test_pairs_of_near_texts_are_bounded_by_their_size(spark):
    def alike(n, different):
        bits = "".join("1" if i < different else "0" for i in range(384))
        words = [int(bits[i : i + 64], 2) for i in range(0, 384, 64)]
        words = [w - (1 << 64) if w >= 1 << 63 else w for w in words]
        zeros = [0] * 6 * minhash_dedup.PLANES
        row = spark.createDataFrame([((n, words + zeros[6:]), (n, zeros))], "x struct<n:long,low:array<long>>, y struct<n:long,low:array<long>>")
        return row.select(minhash_dedup.alike(F.col("x"), F.col("y"))).first()[0]

    assert [alike(146, d) for d in (112, 113)] == [True, False]
    assert [alike(800, d) for d in (115, 116)] == [True, False]
    assert [alike(5000, d) for d in (121, 122)] == [True, False]


def test_a_near_pair_is_made_under_one_of_its_keys(spark):
    seen = []

    def verify(pairs):
        seen.append(sorted(tuple(r) for r in pairs.collect()))
        return pairs.where("false")

    facts = spark.createDataFrame([(i, [7, 8, 9, 10 + i], 1) for i in range(4)], "node long, keys array<long>, sketch int")
    assert link_buckets(facts, lambda x, y: x == y, verify).count() == 0
    assert seen[1] == [(a, b) for a in range(4) for b in range(a + 1, 4)]


def test_wanted_rows_are_sieved_before_the_shuffle(spark):
    rows = spark.range(3000).select(F.col("id"), F.col("id").cast("string").alias("text"))
    wanted = rows.where("id % 7 = 0").select("id")
    got = among(rows, wanted, "id")
    assert sorted((r.id, r.text) for r in got.collect()) == [(i, str(i)) for i in range(0, 3000, 7)]
    assert among(rows, wanted.where("false"), "id").count() == 0
    assert "bitmap_construct_agg" in got._jdf.queryExecution().executedPlan().toString()


def test_scratch_tables_go_once_they_are_used(spark, tmp_path, monkeypatch):
    """What line deduplication leaves in the scratch folder is the names of lines, those repeated and links, no keys and no forms."""
    sets = [prose(300 + i, 40) for i in range(30)]
    texts = [f"{t}\n{t[:-1]}y" for t in sets] + sets
    monkeypatch.setattr(session, "scratch_root", lambda _: str(tmp_path))
    got = line_dedup.dedup_lines(docs_of(spark, texts)).orderBy("doc_id").collect()
    assert [r.n_removed for r in got] == [1] * 60 and all(r.text == s for r, s in zip(got, sets))
    left = {p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()}
    assert "doubled" in left and not left & {"line-classes", "line-keys", "members", "sketches", "compared", "grouped", "open", "open-sketches"}


def test_keys_are_dealt_out_once_and_in_turns(spark):
    """One shuffle of (key, node, spot) serves the count and the join, and it holds a part of the keys."""
    rows = [(i, [(k, 5) for k in range(i % 5, 400, 5)] + [(1000 + i, ANY)], 0) for i, ANY in enumerate([line_dedup.ANYWHERE] * 20)]
    facts = spark.createDataFrame(rows, "node long, keys array<struct<key:long,spot:int>>, sketch int")
    dealt = []

    def keep(df, label):
        if label == "members":
            df.collect()
            dealt.append(df._jdf.queryExecution().executedPlan().toString())
        return session.materialize(df, label)

    old, _jobs.stored = _jobs.stored, keep
    try:
        turns = _jobs._members(facts, ["spot"])
    finally:
        _jobs.stored = old
    assert len(turns) == _jobs.KEY_TURNS > 1 and all("ReusedExchange" in plan for plan in dealt)
    got = sorted(tuple(r) for t in turns for r in t.select("key", "node", "spot").collect())
    assert got == sorted((k, n, 5) for n, keys, _ in rows for k, _ in keys if k < 1000)
    heads = [t.select("key", "head").distinct().count() for t in turns]
    assert sum(heads) == 400 and min(heads) > 0


def test_normal_form_of_ascii_and_other_lines():
    rng = random.Random(6)
    letters = [chr(i) for i in range(300)] + list("٣²½Ⅷİßﬁ")
    for n in range(2000):
        line = "".join(rng.choices(letters[: 128 if n % 2 else None], k=rng.randrange(30)))
        assert line_dedup.normal_form(line) == re.sub(r"[\W_]+", " ", re.sub(r"\d", "0", line.lower())).strip()
