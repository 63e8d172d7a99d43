"""The pipeline over a small corpus with planted cases, against plain code that shares nothing with its operators."""

import hashlib
import random
import re

import corpus_pipeline
import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "key string, row int, node double, score string, words string, matches int, spans string, left string, class_id long"
)
EXTRA = ("k", 1, 0.5, "s", "w", 1, "x", "l", 9)

pick = random.Random(11)
SYLLABLES = ["ka", "lo", "mi", "ren", "tas", "vu", "sel", "nor", "pi", "dag"]
CLEAN = ["".join(pick.choice(SYLLABLES) for _ in range(pick.randrange(1, 5))) for _ in range(900)]
FOUL = ["zxqua", "grubzz", "xyzzok", "quizzx", "zzgrok", "xaxqu"]


def prose(n):
    return [pick.choice(CLEAN) for _ in range(n)]


def corpus():
    """(rows, ids of toxic documents, benchmark rows)."""
    passage, item = prose(60), prose(25)
    texts, toxic = {}, set()
    for i in range(70):
        texts[i] = prose(pick.randrange(40, 160))
    for i in range(100, 125):
        texts[i] = [pick.choice(FOUL) if pick.random() < 0.4 else w for w in prose(70)]
        toxic.add(i)
    texts[200] = list(texts[0])  # a copy
    texts[201] = [*texts[1][:20], "changed", *texts[1][21:]]
    texts[202] = [*texts[201][:-1], "other"]  # near the one before, which is near another
    texts[203] = [w.upper() for w in texts[2]]  # a copy but for its case
    texts[204] = texts[3][len(texts[3]) // 2 :] + texts[3][: len(texts[3]) // 2]  # the same passages in another order
    for i in (5, 6, 7, 8):
        texts[i] = texts[i][:15] + passage + texts[i][15:]
    texts[9] = prose(30) + passage[:34] + prose(5)  # one word short of a window
    for i in (10, 11):
        texts[i] = texts[i][:10] + item[3:18] + texts[i][10:]
    texts[12] = texts[12] + item[:9]  # one word short of an item's window
    texts[13] = texts[13] + ["Lone", "ITEM"]
    texts[14] = texts[14] + ["nameless", "thing", "here"]
    texts[300] = prose(6000)
    rows = [(i, " ".join(w)) for i, w in texts.items()]
    rows += [(200, " ".join(texts[200])), (400, None), (401, ""), (402, ""), (None, " ".join(prose(50))), (None, None), (403, "one two"), (404, "one  TWO!")]
    benchmark = [(1, " ".join(item)), (2, "lone item"), (None, "Nameless THING"), (3, None), (4, ""), (5, " ".join(prose(12)))]
    return [(i, t, "en", None if i == 400 else "s", None if t is None else len(t), *EXTRA) for i, t in rows], toxic, benchmark


ROWS, TOXIC, BENCHMARK = corpus()


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(r[0], 1, int(r[0] in TOXIC)) for r in ROWS if r[0] is not None and r[0] < 200]
    spark.createDataFrame([*labels, (None, 1, 1), (9999, 1, None)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(BENCHMARK, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    seen, real = {}, corpus_pipeline.materialize

    def kept(df, name):
        seen[name] = real(df, name)
        return seen[name]

    corpus_pipeline.materialize = kept
    try:
        seen["tokens"] = corpus_pipeline.run(spark, path)
    finally:
        corpus_pipeline.materialize = real
    return {name: [tuple(r) for r in df.collect()] for name, df in seen.items()} | {"columns": {n: df.columns for n, df in seen.items()}}


def folded(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def edit_distance(a, b, most):
    """The word edit distance, or more than ``most``."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
        if min(row) > most:
            return most + 1
    return row[-1]


def alike(a, b):
    if a == b:
        return True
    shingles = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a, b)]
    common, longer = len(shingles[0] & shingles[1]), max(len(a), len(b))
    if not common or 10 * common < 8 * len(shingles[0] | shingles[1]):
        return False
    return 10 * edit_distance(a, b, longer // 5) <= 2 * longer


def by_key(rows):
    return sorted(rows, key=repr)


def test_toxic_documents_go(stages):
    assert by_key(stages["toxicity"]) == by_key(r for r in ROWS if r[0] not in TOXIC)


def test_one_of_each_class_stays(stages):
    rows = stages["toxicity"]
    words = [folded(r[1]) for r in rows]
    part = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if part[i] != part[j] and alike(words[i], words[j]):
                part = [part[j] if p == part[i] else p for p in part]
    classes = {}
    for p, r in zip(part, rows):
        classes.setdefault(p, []).append(r)
    first = [min(c, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or "")) for c in classes.values()]
    assert by_key(stages["near_duplicates"]) == by_key(first)
    assert any(len({r[0] for r in c}) == 3 for c in classes.values())  # a chain of three


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_repeated_passages_are_cut(stages):
    rows = stages["near_duplicates"]
    places = {}
    for r, row in enumerate(rows):
        words = plain_words(row[1])
        for i in range(len(words) - 34):
            places.setdefault(tuple(words[i : i + 35]), []).append((r, i))
    gone = {(r, i + k) for some in places.values() if len(some) > 1 for r, i in some for k in range(35)}
    want = {}
    for r, row in enumerate(rows):
        left = [w for k, w in enumerate(plain_words(row[1])) if (r, k) not in gone]
        want[row[0], row[1] is None] = (left, (*row[2:4], *row[5:]))
    assert len(gone) == 4 * 60
    for row in stages["passages"]:
        left, others = want.pop((row[0], row[1] is None))
        assert plain_words(row[1]) == left and (*row[2:4], *row[5:]) == others
        assert row[4] == (None if row[1] is None else len(row[1]))
    assert not want


def test_documents_with_benchmark_passages_go(stages):
    windows = set()
    for _, text in BENCHMARK:
        words = folded(text)
        size = min(10, len(words))
        windows |= {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()
    hit = lambda words: any(tuple(words[i : i + n]) in windows for n in {len(w) for w in windows} for i in range(len(words) - n + 1))
    want = [r for r in stages["passages"] if not hit(folded(r[1]))]
    assert by_key(stages["benchmarks"]) == by_key(want)
    assert {r[0] for r in stages["passages"]} - {r[0] for r in want} == {10, 11, 13, 14}


def test_the_rest_is_encoded(stages):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    library.no_truncation()
    library.no_padding()
    want = []
    for r in stages["benchmarks"]:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        text = library.decode(ids, skip_special_tokens=False)
        want.append((r[0], len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), packed))
    names = stages["columns"]["tokens"]
    assert names == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    assert by_key((*r[:4], bytes(r[4])) for r in stages["tokens"]) == by_key(want)


def test_all_stages_but_the_last_keep_the_columns(stages):
    assert all(stages["columns"][name] == [c.split()[0] for c in SCHEMA.split(", ")] for name, _ in corpus_pipeline.STAGES[:-1])


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
