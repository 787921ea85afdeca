"""The trie of conversations against a plain version, and odd rows."""

import hashlib
import random
import zlib

import pytest

from asterism.llm import trie
from asterism.llm.queries import ORACLES

from ..compare import connect


def tag(role, text):
    r, t = (role or "").encode(), (text or "").encode()
    return hashlib.md5(b"%d:%b%d:%b" % (len(r), r, len(t), t)).hexdigest()


def plain(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, tag(role, text), role or "", text or ""))
    own = {conv: [x[3:] for x in sorted(turns)] for conv, turns in own.items()}
    made = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        made[conv] = tuple(own.get(conv - int(abs(conv) % 5 * (1 if conv > 0 else -1)), [])[:h] + turns[h:])
    members = {}
    for conv, turns in made.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(conv)
    out = []
    for node, convs in members.items():
        below = [other for other in members if other[: len(node)] == node]
        children = [other for other in below if len(other) == len(node) + 1]
        leaves = sum(1 for other in below if not any(len(x) == len(other) + 1 and x[: len(other)] == other for x in below))
        saved = sum((len(members[other]) - 1) * (len(other[-1][1].encode()) if other else 0) for other in below)
        ends = ",".join(str(c) for c in sorted(convs) if len(made[c]) == len(node))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture
def found(spark, rows):
    def run(data):
        df = spark.createDataFrame([(*row, 1, "x") for row in data], "conv_id long, turn long, role string, text string, key int, `a.depth` string")
        return rows(trie.conversation_trie(df))

    return run


def test_same_as_plain(found):
    rng = random.Random(2)
    data = [(c, t, rng.choice(["user", "bot"]), rng.choice(["a", "b", "é"])) for c in range(-12, 40) for t in range(rng.choice([0, 1, 2, 3, 9, 17]))]
    assert found(data) == plain(data)


def test_odd_rows(found):
    data = [
        (0, 2, "user", "late"), (0, None, None, "first"), (0, 1, "user", None), (0, 1, "user", None), (0, 1, "bot", "tie"), (None, 0, "user", "nobody's"),
        (1, 0, "", "first"), (2, 0, "user", "x" * 100_000), (3, 0, "us", "er:x"), (4, 0, "user", ":x"), (9, 5, "user", "no base"), (-3, 0, "user", "below zero"),
    ]
    assert found(data) == plain(data)
    assert found([]) == []
    assert found([(None, 0, "user", "x")]) == []


def test_long_and_equal_conversations(found):
    same = [(c, t, "user", str(t)) for c in range(100, 160) for t in range(12)]
    data = [*same, *[(7, t, "user", str(t % 3)) for t in range(70)]]
    assert found(data) == plain(data)


def test_members_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "KEY_BITS", 3)
    keys = [*range(-40, 40), 10**15]
    ends = spark.createDataFrame([(trie.ROOT, k) for k in keys] + [(b"x" * 16, 5)], "node binary, key long")
    got = {bytes(r["node"]): r["ends_sha256"] for r in trie.ends_digest(ends).collect()}
    assert got == {trie.ROOT: hashlib.sha256(",".join(map(str, sorted(keys))).encode()).hexdigest(), b"x" * 16: hashlib.sha256(b"5").hexdigest()}


def test_sql_is_the_plain_version():
    con = connect("/root/testdata/sf0.001")
    got = con.sql(ORACLES["op13_prefix_trie"])
    assert sorted(got.fetchall(), key=repr) == plain(con.sql("SELECT conv_id, turn, role, text FROM conversations").fetchall())
