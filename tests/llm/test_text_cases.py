"""Nulls, empty and long texts, ties, repeated rows, empty tables, and extra columns of clashing names."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from asterism.llm import bpe, decontaminate, fingerprints, htmltext, langid, lines, quality, simhash, substrings, urls
from asterism.llm.common import components

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
KINDS = "doc_id long, text string, lang string, source string, n_chars long, key long, _row string, score double, id long"
LONG = " ".join(f"word{i}" for i in range(60_000))


@pytest.fixture(scope="module")
def odd(spark):
    """Documents with every odd case."""
    english, german = "the cat sat on the mat and looked at the dog. " * 6, "der hund sah die katze und lief in den garten. " * 6
    texts = [(1, english, "en"), (2, german, "de"), (3, None, "en"), (4, "", None), (5, " \n\t ", "de"), (6, "12 !?", "en")]
    texts += [(7, english, "en"), (7, english, "en"), (None, german, None), (8, LONG, "en"), (9, english[:-2] + "x.", None), (10, "été " * 40, "fr")]
    rows = [(i, text, lang, "s", None if text is None else len(text), -1, "r", 2.0, 5) for i, text, lang in texts]
    return spark.createDataFrame(rows, KINDS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], KINDS)


def by_id(df, *names):
    return sorted((tuple(row) for row in df.select("doc_id", *names).collect()), key=repr)


def test_components(spark):
    links = spark.createDataFrame([(5, 4), (4, 9), (9, 1), (7, 8), (3, 3), (4, 5)], "a long, b long")
    assert {tuple(r) for r in components(links).collect()} == {(4, 1), (5, 1), (9, 1), (8, 7)}
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    assert {r["component"] for r in components(chain).collect()} == {0}


def test_fingerprints(odd, empty, spark):
    rows = by_id(fingerprints.fingerprinted(odd), "n_chars", "fingerprint", "near_next")
    assert len(rows) == 12
    same = {row[2] for row in rows if row[0] in (1, 7)}
    assert len(same) == 1 and {row[2] for row in rows if row[0] in (3, 4)} == {"0" * 32}
    assert fingerprints.fingerprinted(empty).collect() == []
    alone = fingerprints.fingerprinted(odd.where("doc_id = 1")).first()
    assert alone["near_next"] == 1 and alone["n_chars"] == 276


def test_fingerprints_grow_until_they_peel(spark):
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(10**6)}." for _ in range(40)) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    few = fingerprints.fingerprinted(docs, least=1, range_bytes=3000)
    assert by_id(few, "near_edited", "near_next") == by_id(fingerprints.fingerprinted(docs), "near_edited", "near_next")
    versions = fingerprints.with_next(docs, "doc_id", "text")
    versions = versions.select("range", "place", "key", F.array(F.lit(0).cast("long")).alias("facts"), F.array(*[fingerprints.paragraph_digests(F.col(c)) for c in ("text", "next", "next")]).alias("versions"))
    tight = versions.withColumn("versions", F.expr("transform(versions, v -> slice(v, 1, 12))"))
    cells = fingerprints.subtracted(fingerprints.sketches(tight, least=1, scale=1))
    assert fingerprints.peeled(cells, rounds=1).agg(F.sum("s1")).first()[0] >= 0


def test_lines(odd, empty):
    rows = by_id(lines.line_classes(odd), "line_no", "class_doc", "kept")
    assert (1, 0, 1, True) in rows and rows.count((7, 0, 1, False)) == 2 and (9, 0, 1, False) in rows
    assert not any(row[0] in (3, 4) for row in rows)
    left = lines.without_repeated_lines(odd)
    assert left.columns == odd.columns and left.count() == odd.count()
    texts = {row["doc_id"]: row["text"] for row in left.collect()}
    assert texts[7] == "" and texts[3] is None and texts[8] == LONG and texts[None] is not None
    assert lines.line_classes(empty).collect() == [] and lines.without_repeated_lines(empty).collect() == []


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def _edited(rng, text, edits):
    letters = list(text)
    for _ in range(edits):
        at = rng.randrange(len(letters) + 1)
        kind = rng.random()
        if kind < 0.4 or not letters:
            letters.insert(at, rng.choice("abé"))
        elif kind < 0.7:
            letters.pop(min(at, len(letters) - 1))
        else:
            letters[min(at, len(letters) - 1)] = rng.choice("abé")
    return "".join(letters)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_lines_find_every_pair(spark, edits):
    rng = random.Random(edits)
    base = ["".join(rng.choice("ab c") for _ in range(rng.randint(16, 30))) for _ in range(20)]
    texts = sorted({_edited(rng, rng.choice(base), rng.randint(0, 4)) for _ in range(150)} - {""})
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = lines.occurrences(docs)
    names = {row["id"]: row["line"] for row in rows.collect()}
    got = {frozenset((names[r["a"]], names[r["b"]])) for r in lines.links(rows.select("id", "line"), edits).collect()}
    long = [t for t in texts if len(t) >= lines.LEAST_CHARS]
    assert got == {frozenset((a, b)) for i, a in enumerate(long) for b in long[:i] if _distance(a, b) <= edits}


@pytest.mark.parametrize("edits, blank", [(1, " "), (2, "é"), (2, " ")])
def test_lines_find_every_pair_of_long_lines(spark, edits, blank):
    rng = random.Random(edits)
    vocabulary = ["".join(rng.choice("abcé") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    base = [blank.join(rng.choice(vocabulary) for _ in range(rng.randint(12, 50))) for _ in range(5)]
    texts = set(base)
    for _ in range(40):
        text = rng.choice(base)
        if rng.random() < 0.4:  # other words
            parts = text.split(blank)
            for at in rng.sample(range(len(parts)), rng.randint(1, 2)):
                parts[at] = rng.choice(vocabulary)
            texts.add(blank.join(parts))
        else:
            texts.add(_edited(rng, text, rng.randint(1, 10)))
    docs = spark.createDataFrame(list(enumerate(sorted(texts))), "doc_id long, text string")
    rows = lines.occurrences(docs)
    names = {row["id"]: row["line"] for row in rows.collect()}
    got = {frozenset((names[r["a"]], names[r["b"]])) for r in lines.links(rows.select("id", "line"), edits).collect()}
    long = [t for t in sorted(texts) if len(t) >= lines.LEAST_CHARS]
    near = [(a, b, max(edits, min(len(a), len(b)) // 32)) for i, a in enumerate(long) for b in long[:i]]
    near = [(a, b, most, _distance(a, b)) for a, b, most in near if abs(len(a) - len(b)) <= most]
    assert got == {frozenset((a, b)) for a, b, most, apart in near if apart <= most}
    assert sum(edits < apart <= most for *_, most, apart in near) >= 8


def test_long_lines_are_shuffled_once_for_both_sides(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(300).selectExpr("id", "repeat(concat('word', cast(id as string), ' '), 30) AS line").withColumn("length", F.char_length("line"))
        met = lines._by_words(rows, 2)
        met.collect()
        assert "ReusedExchange" in met._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_long_lines_that_only_share_words_do_not_meet(spark):
    rng = random.Random(5)
    frequent = ["".join(rng.choice("abcdefgh") for _ in range(10)) for _ in range(12)]
    texts = []
    for _ in range(100):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(40)]
        for at, word in zip(rng.sample(range(1, 39, 3), 6), rng.sample(frequent, 6)):
            words[at] = word
        texts.append(" ".join(words))
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, line string").withColumn("length", F.char_length("line"))
    assert lines._by_words(rows, 2).distinct().count() <= 100  # of 4950 pairs
    # Not two keys and more for each edit.
    assert sum(len(r["keys"]) / (r["length"] // 32 + 1) for r in lines._chunk_keys(rows, 2).collect()) < 2 * len(texts)


@pytest.mark.parametrize("blank", ["", " " * 3, " x "])
def test_long_lines_of_few_or_repeated_words(spark, blank):
    rng = random.Random(7)
    base = [blank.join(rng.choice(["ab", "c", "dddé", "eeeeeeeeeeeeeeeeeeeeeeeeeeeee"]) for _ in range(80))[:rng.randint(96, 260)] for _ in range(4)]
    texts = sorted({_edited(rng, rng.choice(base), rng.randint(0, 9)) for _ in range(60)})
    rows = spark.createDataFrame([(t,) for t in texts], "line string").select(F.xxhash64("line").alias("id"), "line")
    names = {row["id"]: row["line"] for row in rows.collect()}
    got = {frozenset((names[r["a"]], names[r["b"]])) for r in lines.links(rows).collect()}
    near = [(a, b, max(2, min(len(a), len(b)) // 32)) for i, a in enumerate(texts) for b in texts[:i]]
    assert got == {frozenset((a, b)) for a, b, most in near if abs(len(a) - len(b)) <= most and _distance(a, b) <= most}


def test_long_lines_are_compared_between_their_ends(spark):
    rng = random.Random(3)
    base = "".join(rng.choice("ab é") for _ in range(300))
    pairs = [(base[:n], _edited(rng, base[:n], rng.randint(0, 9)), rng.randint(0, 8)) for n in (1, 7, 8, 16, 40, 100, 300) for _ in range(6)]
    pairs += [("a" * n, "a" * m, most) for n, m, most in ((50, 52, 1), (50, 52, 2), (8, 16, 7), (8, 16, 8), (9, 9, 0))]
    rows = spark.createDataFrame(pairs, "x string, y string, most int")
    got = rows.select("*", lines._within_long(F.col("x"), F.col("y"), F.col("most")).alias("near")).collect()
    assert all(r["near"] == (_distance(r["x"], r["y"]) <= r["most"]) for r in got) and len({r["near"] for r in got}) == 2


def test_substrings(odd, empty, spark):
    rows = by_id(substrings.without_repeats(odd), "n_words", "n_removed", "kept")
    kept = {row[0]: row for row in rows}
    assert kept[3][1:] == (0, 0, "") == kept[4][1:] and kept[8][2] == 0 and kept[1][2] == 0
    assert kept[7][1] == kept[7][2] and sum(row[0] == 7 for row in rows) == 2 and kept[None][2] == 0
    assert substrings.without_repeats(empty).collect() == []


@pytest.mark.parametrize("shard, crowd", [(1, 2), (substrings.SHARD, substrings.CROWD)])
def test_substrings_by_shards_and_by_rows(spark, shard, crowd):
    rng = random.Random(7)
    shared = [" ".join(rng.choice("abcdef") * rng.randint(1, 3) for _ in range(40)) for _ in range(6)]
    texts = []
    for i in range(60):
        parts = [" ".join(str(rng.randrange(10**6)) for _ in range(rng.randint(0, 9)))]
        for passage in rng.sample(shared, rng.randint(0, 3)):
            words = passage.split()
            at = rng.randint(0, 20)
            parts += [" ".join(words[at : at + rng.randint(8, 25)]), str(rng.randrange(10**6))]
        texts.append(" ".join(parts))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {row["doc_id"]: row["kept"] for row in substrings.without_repeats(docs, shard=shard, crowd=crowd).collect()}
    first = {}
    for i, text in enumerate(texts):
        words = text.split()
        for k in range(len(words) - 12):
            first.setdefault(tuple(words[k : k + 13]), i)
    for i, text in enumerate(texts):
        words = text.split()
        gone = {j for k in range(len(words) - 12) if first[tuple(words[k : k + 13])] < i for j in range(k, k + 13)}
        assert got[i] == " ".join(word for j, word in enumerate(words) if j not in gone)


def test_simhash(odd, empty):
    rows = by_id(simhash.near_duplicates(odd), "fingerprint", "component_id")
    found = {row[0]: row for row in rows}
    assert len(rows) == 12 and found[7][2] == 1 and found[3][1:] == ("0" * 16, 3) == found[4][1:] and found[None][2] == 2
    assert simhash.near_duplicates(empty).collect() == []


@pytest.mark.parametrize("bits, pairwise", [(0, 32), (1, 2), (2, 2), (2, 32), (3, 2)])
def test_simhash_links(spark, bits, pairwise):
    rng = random.Random(bits)
    centres = [rng.getrandbits(64) for _ in range(4)]
    values = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for c in centres for _ in range(60)}
    signed = {simhash._signed(v): v for v in values}
    links = simhash.fingerprint_links(spark.createDataFrame([(v,) for v in signed], "fp long"), bits, pairwise)
    got = [(signed[r["a"]], signed[r["b"]]) for r in links.collect()]
    assert all((a ^ b).bit_count() <= bits for a, b in got)

    def grouped(pairs):
        group = {v: v for v in values}
        for a, b in pairs:
            old, new = sorted((group[a], group[b]), reverse=True)
            group = {v: new if g == old else g for v, g in group.items()}
        return group

    assert grouped(got) == grouped([(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= bits])


def test_decontamination(odd, empty, spark):
    item = "a paraphrase of this question about rivers that flow north ends with the long answer nile"
    words = item.split()
    changed = " ".join(w if i % 4 else "zzz" for i, w in enumerate(words[:-4])) + " " + " ".join(words[-4:])
    wrong = " ".join(words[:11]) + " quite another reply altogether"
    texts = [(20, f"{LONG} {item.upper()}! {LONG}"), (21, f"so {changed} and so"), (22, wrong), (23, item[:30]), (None, item)]
    rows = [(i, text, None, None, None, None, None, None, None) for i, text in texts]
    docs = odd.unionAll(spark.createDataFrame(rows, KINDS))
    benchmark = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (None, "x"), (4, "too short")], "item_id long, text string")
    got = decontaminate.leaks(docs, benchmark).select("doc_id", "item_id").distinct().collect()
    assert {tuple(r) for r in got} >= {(20, 1), (21, 1), (None, 1)} and {r["doc_id"] for r in got} <= {20, 21, None}
    left = decontaminate.without_leaks(docs, benchmark)
    assert left.columns == docs.columns and not {20, 21} & {r["doc_id"] for r in left.collect()}
    assert left.where("doc_id is null").count() == 2
    assert decontaminate.leaks(empty, benchmark).collect() == [] and decontaminate.leaks(docs, benchmark.limit(0)).collect() == []


def test_urls(spark):
    rows = [(None, None), ("no scheme", 1), ("http://", 0), ("HTTP://A.Example.NET/en/1?x#y", None), ("a://b://c/d", None), ("x://net?q=/en/", 1)]
    rows += [(f"http://h.test/{'spam' if i % 2 else 'fine'}/{i}", i % 2) for i in range(400)] + [("http://h.test/spam/" + "x/" * 3000, 1)]
    pages = spark.createDataFrame([(i, url, bad, "t", 3) for i, (url, bad) in enumerate(rows)], "page_id long, url string, bad int, template string, n int")
    rules = [("block", "net/"), ("allow", "example.net/en/")]
    got = {row["page_id"]: row for row in urls.judged(pages, rules).collect()}
    assert len(got) == len(rows) and got[0]["host"] == got[1]["path"] == "" and got[2]["host"] == ""
    assert (got[3]["host"], got[3]["path"], got[3]["rule"], got[3]["verdict"]) == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert (got[4]["host"], got[4]["path"]) == ("b:", "//c/d") and got[5]["rule"] is None
    assert {got[i]["verdict"] for i in range(6, 406) if i % 2} == {"block"} and {got[i]["verdict"] for i in range(6, 406) if not i % 2} == {"allow"}
    assert got[7]["template"] == "/spam/*" and urls.judged(pages.limit(0), rules).collect() == []


def test_html(spark, odd):
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><nav><a href=x>Home</a></nav><div class='cookie-notice'>We use "
        "cookies to make this site work well for you and all others who visit it</div><div id=main><h1>A &amp; B</h1><p>One <b>two</b>&nbsp;three "
        "four five six seven eight nine ten eleven twelve thirteen fourteen<p>Last &lt;line&gt;<br>end<form>no</form></div><section "
        "class=comments><p>A reader says quite a lot here, more than enough words to be taken for text</p></section><footer>&copy;</footer><script>x<y"
    )
    text = "A & B One two three four five six seven eight nine ten eleven twelve thirteen fourteen Last <line> end"
    assert htmltext.main_text(page) == text
    rows = [(1, page, "old"), (1, page, "old"), (2, None, None), (3, "", ""), (4, "plain", ""), (5, "<p>" + "x " * 100_000, ""), (6, "<a href='" + "<" * 5000, "")]
    got = htmltext.with_main_text(spark.createDataFrame(rows, "page_id long, html string, text string"))
    found = {row["page_id"]: row["text"] for row in got.collect()}
    assert got.columns == ["page_id", "html", "text", "n_chars"]
    assert (found[1], found[2], found[3], found[4], len(found[5])) == (text, "", "", "plain", 199_999)
    assert htmltext.with_main_text(odd.limit(0), "text").collect() == []


@pytest.mark.parametrize("name", ["article", "main"])
def test_html_keeps_all_of_an_article(name):
    long, short = "a long paragraph of the article " * 16, "A short closing paragraph."
    aside = "<aside><p>one</p><p>two</p><p>three</p></aside>"
    page = f"<p>{long} outside</p><{name}><p>{long}</p>{aside}<p>{short}</p></{name}><p>after</p>"
    assert htmltext.main_text(page) == f"{long}{short}"
    links = "".join(f"<li><a href=x>link {i}</a></li>" for i in range(5))
    page = f"<{name}><p>{long}</p><ul>{links}</ul><p>{short}</p></{name}><ul>{links}</ul>"
    assert htmltext.main_text(page) == f"{long}link 0 link 1 link 2 link 3 link 4 {short}"


def test_quality(odd, empty, spark):
    labels = spark.createDataFrame([(1, 1), (2, 1), (6, 0), (4, 0), (4, 0), (None, 1), (8, None)], "doc_id long, quality int")
    rows = by_id(quality.scored(odd, labels), "score", "kept")
    assert len(rows) == 12 and all(0 <= row[1] <= 1 for row in rows) and len({row[1] for row in rows if row[0] == 7}) == 1
    one = quality.scored(odd, labels.where("quality = 1"))
    assert {row["score"] for row in one.collect()} == {1.0}
    assert {row["score"] for row in quality.scored(odd, labels.limit(0)).collect()} == {0.5}
    assert quality.scored(empty, labels).collect() == []


def test_bpe(odd, empty):
    library = Tokenizer.from_file(VOCABULARY)
    rng = random.Random(1)
    automaton = bpe.compile_automaton(open(VOCABULARY, "rb").read())
    texts = ["", "<|endoftext|>", "a<|endoftext|> b", "a" * 999, "日本語 😀", "\x00\x1c\x85 x　 ", "it's I'LL we'd", "z" * 20_000]
    texts += ["".join(rng.choice("aeinst '\n é1½日😀_-=") for _ in range(rng.randint(1, 60))) for _ in range(500)]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert automaton.encode(text) == ids and automaton.decode(ids) == text
    coded = bpe.with_encoding(odd, VOCABULARY)
    assert coded.columns == [*odd.columns, "n_tokens", "ids_sha256", "decoded_sha256"] and coded.count() == 12
    assert {row["n_tokens"] for row in coded.where("doc_id in (3, 4)").collect()} == {0}
    ids = odd.select("doc_id", bpe.token_ids(F.col("text"), odd, VOCABULARY).alias("ids"), "text")
    back = ids.select("text", bpe.texts_of(F.col("ids"), ids, VOCABULARY).alias("back")).collect()
    assert all((row["text"] or "") == row["back"] for row in back)
    assert bpe.with_encoding(empty, VOCABULARY).collect() == []


def test_language(odd, empty, spark):
    model = langid.fit(odd)
    assert model.languages == ["de", "en", "fr"]
    rows = langid.with_language(odd, model)
    assert rows.columns == [name for name in odd.columns if name != "score"] + ["lang_pred", "score"]
    found = {row["doc_id"]: row["lang_pred"] for row in rows.collect()}
    assert (found[1], found[2], found[None], found[10]) == ("en", "de", "de", "fr")
    assert {found[i] for i in (3, 4, 5, 6)} == {"und"}
    nothing = langid.fit(empty)
    assert nothing.languages == [] and {r["lang_pred"] for r in langid.with_language(odd, nothing).collect()} == {"und"}
    assert langid.with_language(empty, model).collect() == []
