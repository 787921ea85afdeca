"""Registered queries on the smallest tables against brute force, and SQL where there is some."""

import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from asterism.llm import decontaminate, htmltext, queries, urls

from ..compare import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.fixture(scope="module")
def documents(con):
    return con.sql("SELECT doc_id, text, lang FROM documents ORDER BY doc_id DESC").fetchall()


def found(spark, name, key="doc_id"):
    rows = queries.QUERIES[name](spark, FOLDER).collect()
    return {row[key]: row for row in rows}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, con, name):
    assert differences(queries.QUERIES[name](spark, FOLDER), con, queries.ORACLES[name]) == []


def test_fingerprints(spark, documents):
    got = found(spark, "op1_fingerprints")
    assert len(got) == len(documents)
    prints = {}

    def paragraphs(text):
        return {p for p in re.split(r"\n+|(?<=[.!?])\s+", text, flags=re.A) if p}

    def likeness(a, b):
        return len(a & b) / len(a | b) if a | b else 1.0

    for i, (doc, text, _) in enumerate(documents):
        following = documents[(i + 1) % len(documents)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        row = got[doc]
        assert row["n_chars"] == len(text) and row["edited_sha256"] == sha(edited)
        assert row["near_edited"] == pytest.approx(likeness(paragraphs(text), paragraphs(edited)))
        assert row["near_next"] == pytest.approx(likeness(paragraphs(text), paragraphs(following)))
        assert prints.setdefault(text, row["fingerprint"]) == row["fingerprint"]
        assert prints.setdefault(edited, row["edited_fingerprint"]) == row["edited_fingerprint"]
    assert len(set(prints.values())) == len(prints)


def test_simhash(spark, documents):
    def fingerprint(text):
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
        shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        counts = [0] * 64
        for shingle in shingles:
            h = xxhash.xxh64_intdigest(shingle, 42)
            for bit in range(64):
                counts[bit] += h >> bit & 1
        return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(shingles))

    got = found(spark, "op4_simhash")
    prints = {doc: fingerprint(text) for doc, text, _ in documents}
    component = {doc: doc for doc in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            near = min(component[b] for b in prints if (prints[a] ^ prints[b]).bit_count() <= 2)
            changed |= near < component[a]
            component[a] = min(near, component[a])
    assert {doc: (row["fingerprint"], row["component_id"]) for doc, row in got.items()} == {
        doc: (f"{prints[doc]:016x}", component[doc]) for doc in prints
    }


def test_decontamination(spark, con, documents):
    def plain(text):
        return b" " + b" ".join(decontaminate._plain(text.encode()).split()) + b" "

    items = con.sql("SELECT item_id, text FROM benchmark").fetchall()
    verbatim = {(doc, i) for doc, text, _ in documents for i, item in items if plain(item) in plain(text)}
    rows = queries.QUERIES["op5_decontaminate"](spark, FOLDER).collect()
    assert verbatim and verbatim == {(row["doc_id"], row["item_id"]) for row in rows if row["lcs_share"] == 1}


def test_urls(spark, con):
    pages = con.sql("SELECT page_id, url FROM pages").fetchall()
    got = found(spark, "op6_url_templates", "page_id")
    assert len(got) == len(pages)
    for page, url in pages:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host) :])[0]
        fits = [
            (len(rule), rule, verdict)
            for verdict, rule in queries.URL_RULES
            for domain, start in [rule.split("/", 1)]
            if (host == domain or host.endswith("." + domain)) and path.startswith("/" + start)
        ]
        row = got[page]
        assert (row["host"], row["path"], row["rule"]) == (host, path, max(fits)[1] if fits else None)
        assert row["verdict"] == (max(fits)[2] if fits else "block" if row["purity"] >= urls.REJECTED else "allow")


def test_html(spark, con):
    got = found(spark, "op7_html_text", "page_id")
    for page, raw in con.sql("SELECT page_id, html FROM pages").fetchall():
        article = re.search(r"<article>(.*)</article>", raw, re.S)[1]
        article = re.sub(r"</?(?:p|h1|br)\b[^>]*>", " ", article)
        text = " ".join(re.sub(r"<[^>]*>", "", article).replace("&quot;", '"').replace("&amp;", "&").split())
        assert got[page]["text"] == text and got[page]["n_chars"] == len(text)


def test_quality_tells_labelled_documents_apart(spark, con):
    labels = dict(con.sql("SELECT doc_id, quality FROM labels").fetchall())
    got = found(spark, "op8_quality")
    good = np.array([got[doc]["score"] for doc, quality in labels.items() if quality])
    bad = np.array([got[doc]["score"] for doc, quality in labels.items() if not quality])
    assert (good[:, None] > bad[None, :]).mean() > 0.9


def test_bpe(spark, documents):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = found(spark, "op9_bpe")
    for doc, text, _ in documents:
        ids = library.encode(text, add_special_tokens=False).ids
        row = got[doc]
        assert row["n_tokens"] == len(ids) and row["ids_sha256"] == sha(",".join(map(str, ids)))
        assert row["decoded_sha256"] == sha(library.decode(ids, skip_special_tokens=False))


def test_language_of_held_out_documents(spark, documents):
    got = found(spark, "op10_langid")
    held = [(row["lang_pred"], lang) for doc, _, lang in documents for row in [got[doc]] if row["held_out"]]
    assert held and np.mean([a == b for a, b in held]) > 0.95
    assert all(0 <= row["score"] <= 1 for row in got.values())


def test_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))
    assert htmltext.main_text(None) == ""
