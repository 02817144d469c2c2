"""Registered queries of the package on the small tables, and the pipeline's stages against plain rules."""

import os
import random
import re
from collections import Counter
from itertools import combinations

import pytest

pytest.importorskip("foliar.llm")

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from compare import compare, connect  # noqa: E402
from foliar.llm import line_dedup, queries  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.mark.parametrize("name", sorted(queries.SQL_TEXT))
def test_query_equals_sql(spark, name):
    assert compare(entry.queries()[name](spark, SF), connect(SF), entry.oracle_sql()[name]) is None


def test_line_stage_with_clashing_columns_and_missing_values(spark):
    rows = [(2, "A line that is long enough.\nOther words here.", 3, "x"), (1, "A line that is long enough.", 9, "y"), (None, None, None, "z"), (3, "a LINE that is long enough", 1, "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, row_number string")
    got = sorted(((r.doc_id, r.text, r.row_number) for r in corpus_pipeline.lines(spark, docs, SF).collect()), key=str)
    assert got == sorted([(1, "A line that is long enough.", "y"), (2, "Other words here.", "x"), (None, None, "z")], key=str)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


def test_stage_inputs_are_stored_packed(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows, key = corpus_pipeline._numbered(docs)
    assert rows.count() == docs.count() and rows.columns == [key, *docs.columns]
    assert all(".zstd." in name for name in rows.inputFiles())


WORDS = re.compile("[^\x20\x09-\x0d]+")


def prose(seed, n, pool=400):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abdeghilmnorstuvw") for _ in range(rng.randint(3, 9))) for _ in range(pool)]
    return " ".join(rng.choice(words) for _ in range(n))


def shingles(text):
    words = WORDS.findall((text or "").lower())
    return Counter(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, min(len(words), 1))))


def planted():
    """Clean texts, exact and near copies, a benchmark passage whole and changed, a repeated line, refused and empty texts."""
    item = prose(900, 40)
    clean = {i: prose(i, 60 + i) for i in range(30)}
    texts = dict(clean)
    texts[100] = clean[3]
    texts[101] = clean[4].replace(" ", " other ", 1)
    texts[102] = " ".join(w if i % 12 else f"w{i}" for i, w in enumerate(clean[5].split()))  # too far apart
    texts[103] = f"{prose(901, 50)} {item} {prose(902, 50)}"
    texts[104] = f"{prose(903, 30)} {item.replace(' ', ' else ', 1)}"
    texts[105] = f"{prose(904, 30)} {' '.join(item.split()[:15])}"  # too little of it
    texts[106], texts[107] = (f"{prose(s, 40)}\nThis line stands in two texts of the corpus.\n{prose(s + 9, 40)}" for s in (905, 906))
    texts[108], texts[109], texts[110] = "too short", prose(907, 9) + " " + " ".join([prose(908, 20)] * 4), None
    return item, clean, texts


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    item, clean, texts = planted()
    folder = str(tmp_path_factory.mktemp("planted"))
    docs = [(i, t, "en" if i % 2 else "de", "src0", len(t or "")) for i, t in texts.items()]
    tables = {
        "documents": (docs, "doc_id long, text string, lang string, source string, n_chars long"),
        "labels": ([(i, 1, 0) for i in clean], "doc_id long, quality int, toxic int"),
        "benchmark": ([(0, item), (1, None)], "item_id long, text string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder, item, clean, texts


def kept_by(spark, corpus, stage):
    docs = spark.read.parquet(f"{corpus[0]}/documents.parquet")
    return {r.doc_id: r for r in dict(corpus_pipeline.STAGES)[stage](spark, docs, corpus[0]).collect()}


def test_quality_stage_equals_the_plain_rules(spark, corpus):
    def failed(text):
        words = WORDS.findall(text or "")
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        times = Counter(windows)
        repeated = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(8)}
        return len(words) < 20 or 100 * len(repeated) > 30 * len(words)

    # All labels are good, so nothing is learned and the base rules decide.
    want = {i for i, t in corpus[3].items() if not failed(t)}
    assert set(kept_by(spark, corpus, "quality_rules")) == want and {108, 109, 110} == set(corpus[3]) - want


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_line_stage_equals_plain_edit_similarity(spark, corpus):
    got = kept_by(spark, corpus, "line_dedup")
    forms = {(i, j): re.sub(r"[\W_]+", " ", re.sub(r"\d", "0", x.lower())).strip() for i, t in sorted(corpus[3].items()) for j, x in enumerate((t or "").split("\n"))}
    forms = {place: form for place, form in forms.items() if len(form) >= line_dedup.MIN_CHARS}
    root = {place: place for place in forms}
    for p, q in combinations(sorted(forms), 2):
        a, b = forms[p], forms[q]
        # Lines that share hardly a word are not alike.
        if 2 * len(set(a.split()) & set(b.split())) >= len(set(a.split())) and 10 * plain_distance(a, b) <= max(len(a), len(b)):
            old, new = max(root[p], root[q]), min(root[p], root[q])
            root = {x: new if r == old else r for x, r in root.items()}
    gone = {place for place, r in root.items() if r != place}
    assert {i for i, _ in gone} == {100, 101, 102, 107}
    want = {}
    for i, text in corpus[3].items():
        lines = (text or "").split("\n")
        left = [x for j, x in enumerate(lines) if (i, j) not in gone]
        if left == lines or "\n".join(left).strip():
            want[i] = None if text is None else "\n".join(left)
    assert {i: r.text for i, r in got.items()} == want and not {100, 101, 102} & set(got)
    assert all(r.n_chars == len(r.text or "") for r in got.values())


def test_near_duplicate_stage_equals_brute_force(spark, corpus):
    sets = {i: set(shingles(t)) for i, t in sorted(corpus[3].items())}
    root = {i: i for i in sets}
    for a, b in combinations(sets, 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            old, new = max(root[a], root[b]), min(root[a], root[b])
            root = {i: new if r == old else r for i, r in root.items()}
    groups = {}
    for i, r in root.items():
        groups.setdefault(r, set()).add(i)
    got = set(kept_by(spark, corpus, "minhash_near_dedup"))
    assert sorted(map(sorted, (g for g in groups.values() if len(g) > 1))) == [[3, 100], [4, 101]]
    assert all(len(g & got) == 1 for g in groups.values())


def test_decontamination_stage_equals_brute_force(spark, corpus):
    _, item, _, texts = corpus
    want, n = shingles(item), len(item.split())

    def holds(text):
        words = WORDS.findall((text or "").lower())
        for i in range(len(words) - n + 1):
            found = shingles(" ".join(words[i : i + n]))
            if 100 * (found & want).total() >= 75 * (found | want).total():
                return True
        return False

    gone = {i for i, t in texts.items() if holds(t)}
    assert gone == {103, 104} and set(kept_by(spark, corpus, "benchmark_decontamination")) == set(texts) - gone


def test_mixing_stage_meets_the_targets_of_the_languages_found(spark, corpus):
    got = kept_by(spark, corpus, "source_mixing")
    total = sum(len(WORDS.findall(t or "")) for t in corpus[3].values())
    assert all(r.rate > 0 and r.copies in (int(r.rate), int(r.rate) + 1) for r in got.values())
    # The rates fill the budget: as many expected tokens as there are.
    assert abs(sum(r.rate * r.tokens for r in got.values()) - total) < 0.02 * total
    assert all(r.text == corpus[3][i] for i, r in got.items())


def test_whole_pipeline_keeps_clean_documents(spark, corpus):
    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, corpus[0]).collect()}
    assert set(corpus[2]) <= set(rows) and not {100, 101, 103, 104, 108, 109, 110} & set(rows)
    assert all(rows[i].text == t for i, t in corpus[2].items())


def test_stages_of_an_empty_table(spark, corpus):
    docs = spark.read.parquet(f"{corpus[0]}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, corpus[0]).count() == 0
