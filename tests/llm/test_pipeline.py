"""The pipeline against the plain meaning of its stages."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from asterism import session, storage
from asterism.llm import lines, simhash

KINDS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    english, german = "aeiotnsrhl", "äöüßchegzw"
    item = words(rng, english, 30)
    shared = words(rng, english, 12)
    docs = {i: "\n".join(words(rng, english if i % 2 else german, 12) for _ in range(4)) for i in range(40)}
    docs[40] = docs[3]  # a copy
    docs[41] = docs[5] + "\n" + words(rng, english, 40)  # all lines of another and a new one
    docs[42] = words(rng, english, 30) + "\n" + shared + "\n" + words(rng, english, 30)
    docs[43] = shared[:-1] + "q\n" + words(rng, english, 50)  # a line that is one edit from another
    docs[44] = words(rng, english, 20) + " " + item + " " + words(rng, english, 20)
    docs[45], docs[46], docs[47] = None, "", "12 34 !!"
    rows = [(i, t, "en" if i % 2 else "de", "s", None if t is None else len(t)) for i, t in docs.items()]
    rows += [(48, "", None, None, 0)]
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, KINDS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), docs, shared


def test_run(spark, folder):
    path, docs, shared = folder
    got = {row["doc_id"]: row for row in corpus_pipeline.run(spark, path).collect()}
    want = {i: t for i, t in docs.items() if i not in (45, 46, 47)}  # no letter: no language
    want[40], want[41], want[43] = "", want[41].split("\n")[-1], want[43].split("\n")[1]
    prints = {i: simhash.fingerprint_of(t) for i, t in want.items()}
    for i in sorted(want):
        if any((prints[i] ^ prints[j]).bit_count() <= 2 for j in want if j < i):
            del want[i]
    del want[44]  # has a benchmark item
    assert {i: row["text"] for i, row in got.items()} == want
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, text in want.items():
        assert got[i]["n_tokens"] == len(library.encode(text, add_special_tokens=False).ids)
        assert got[i]["n_chars"] == len(text)


def test_stages_hand_over_documents(spark, folder):
    path, _, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, path).columns == docs.columns, name
        assert stage(spark, docs.limit(0), path).collect() == [], name


def test_texts_under_one_id_are_different_documents(spark):
    rng = random.Random(5)
    repeated, *own = [words(rng, "aeiotnsrhl", 14) for _ in range(5)]
    texts = [(1, f"{repeated}\n{own[0]}"), (2, f"{repeated}\n{own[1]}"), (2, f"{own[2]}\n{own[3]}")]
    texts += [(3, repeated[:-1] + "q"), (3, own[2][:-1] + "q"), (4, f"{own[3]}"), (4, own[3][:-1] + "q")]
    rows = [(i, text, None, None, len(text)) for i, text in texts]
    got = {(r["doc_id"], r["text"]) for r in corpus_pipeline.lines_once(spark, spark.createDataFrame(rows, KINDS), "").collect()}
    assert got == {(1, f"{repeated}\n{own[0]}"), (2, own[1]), (2, f"{own[2]}\n{own[3]}"), (3, ""), (4, "")}
    both = spark.createDataFrame([(5, x, None, None, len(x)) for x in (own[0], own[0][:-1] + "q")], KINDS)
    assert sorted(len(r["text"]) for r in corpus_pipeline.lines_once(spark, both, "").collect()) == [0, len(own[0])]


def test_a_near_copy_goes_though_its_id_has_another_text(spark):
    rng = random.Random(6)
    first, other = words(rng, "aeiotnsrhl", 60), words(rng, "aeiotnsrhl", 60)
    alone = [words(rng, "aeiotnsrhl", 60) for _ in range(2)]
    texts = [(1, first), (2, first.upper()), (2, other), (2, other.upper()), (None, other), *((None, x) for x in alone)]
    docs = spark.createDataFrame([(i, text, None, None, len(text)) for i, text in texts], KINDS)
    prints = [simhash.fingerprint_of(text) for _, text in texts]
    assert prints[0] == prints[1] and prints[2] == prints[3] and (prints[0] ^ prints[2]).bit_count() > 2
    left = [(r["doc_id"] or 0, r["text"].lower()) for r in corpus_pipeline.one_of_each(spark, docs, "").collect()]
    assert sorted(left) == sorted([(0, alone[0]), (0, alone[1]), (1, first), (2, other)])


def test_rows_without_an_id_are_filtered(spark, tmp_path):
    rng = random.Random(7)
    item, *own = [words(rng, "aeiotnsrhl", 30) for _ in range(4)]
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    texts = [(1, f"{own[0]}\n{own[1]}"), (1, item), (None, f"{item}"), (None, f"{own[0]}\n{own[2]}"), (None, own[0])]
    docs = spark.createDataFrame([(i, text, None, None, len(text)) for i, text in texts], KINDS)
    left = corpus_pipeline.uncontaminated(spark, docs, str(tmp_path)).collect()
    assert {(r["doc_id"], r["text"]) for r in left} == {t for t in texts if t[1] != item} and len(left) == 3
    left = corpus_pipeline.lines_once(spark, docs, "").collect()
    assert (None, own[2]) in {(r["doc_id"], r["text"]) for r in left} and (None, "") in {(r["doc_id"], r["text"]) for r in left}


def test_extra_columns_of_any_name_and_long_texts(spark, tmp_path):
    rng = random.Random(9)
    item, *own = [words(rng, "aeiotnsrhl", 40) for _ in range(5)]
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    long = words(rng, "aeiotnsrhl", 20_000)
    texts = [(1, own[0], "en"), (1, own[0], "en"), (2, own[1], "en"), (2, own[1], "en"), (3, long, "en"), (4, own[3] + " " + item, "en"), (5, own[2], None)]
    names = "_row string, _place string, place string, doc string, component_id string, hash long, score string, `a.b` int"
    rows = [(i, text, lang, "s", len(text), "r", "p", "q", "d", "c", 5, "x", 1) for i, text, lang in texts]
    spark.createDataFrame(rows, f"{KINDS}, {names}").write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    kept = {row["doc_id"]: row for row in got}
    # The fourth text has the benchmark's item.
    assert sorted(row["doc_id"] for row in got) == [1, 2, 3, 5] and kept[3]["text"] == long
    for row in got:
        assert [row[name] for name in ("_row", "_place", "place", "doc", "component_id", "hash", "score", "a.b")] == ["r", "p", "q", "d", "c", 5, "x", 1]


def test_lines_leave_their_links_alone(spark):
    """Neither shuffle files nor tables that links were found by stay once they are found."""
    docs = spark.createDataFrame([(i, f"a line of text that all have, but for number {i % 7}\nand one more {i}") for i in range(50)], "doc_id long, text string")
    before = set(storage.names(spark, session.scratch_folder(spark)))
    found = lines.links(lines.occurrences(docs).select("id", "line"))
    left = set(storage.names(spark, session.scratch_folder(spark))) - before
    assert [name.rsplit("-", 1)[0] for name in left] == ["lines-links"] and found.count() > 0


def test_a_written_table_drops_its_shuffles(spark, monkeypatch):
    seen, setting = [], session.DROP_SHUFFLES
    df = spark.range(10).repartition(2, "id")
    kind = type(df.write)
    monkeypatch.setattr(kind, "parquet", lambda self, path, write=kind.parquet: seen.append(spark.conf.get(setting, None)) or write(self, path))
    assert session.materialize(df, "dropped").count() == 10
    assert seen == ["true"] and spark.conf.get(setting, None) is None
    spark.conf.set(setting, "false")
    try:
        session.materialize(df, "kept")
    finally:
        spark.conf.unset(setting)
    assert seen == ["true", "false"]
