"""Byte-pair encoding by a deterministic automaton over tokens, and decoding.

The automaton reads a word as a sequence of tokens and accepts exactly the sequence that the
merges give. It starts with one arc per byte. Each merge ``u v`` adds a gadget, in rank order:

- the state behind ``u`` loses its arc ``v``;
- every state that then has an arc ``u`` gets an arc ``uv`` to a copy of the state behind ``v``.

A copy shares all arcs its original had at that time, so a state is stored as the arcs its own
gadgets removed, plus a link to the state it was copied from and the rank up to which the link
holds. An arc is looked up along both chains of links, which are as long as a token's merges.
A word has one accepted path; it is found by taking the longest token with an arc, and undoing
it if nothing follows. A position that led nowhere is not entered twice, so a word takes time
in proportion to its length.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from itertools import chain

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import beside, small_batches

#: The published pattern by which byte-level vocabularies cut a text into words, for given
#: letters, numbers and white space.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
#: First and last code points that newer versions of Unicode made letters or numbers
#: than the one the vocabulary files are used with.
NEWER = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2),
    (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7),
    (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1),
    (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3),
    (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2),
    (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6),
    (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE),
    (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF),
    (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
]
#: Texts with no character from here on are cut by a pattern with plain sets, which is faster.
LATIN_END = 0x250
#: Words and arcs a task remembers before it starts anew.
REMEMBERED = 400_000
FIELDS = "n_tokens long, ids_sha256 string, decoded_sha256 string"

_FOREVER = 1 << 60
_COMPILED: dict[str, MergeAutomaton] = {}


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabulary files print for each byte: itself if it is visible
    Latin-1, else the next free letter from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _splitters() -> tuple[re.Pattern, re.Pattern]:
    """Patterns for texts of Latin letters and for all others."""

    def latin(wanted) -> str:
        return "".join(re.escape(chr(c)) for c in range(LATIN_END) if wanted(chr(c)))

    space = regex.compile(r"\s")
    plain = SPLIT.format(
        L=latin(lambda c: unicodedata.category(c)[0] == "L"),
        N=latin(lambda c: unicodedata.category(c)[0] == "N"),
        S=latin(lambda c: bool(space.match(c))),
    )
    newer = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in NEWER)
    sets = {"L": f"[\\p{{L}}--[{newer}]]", "N": f"[\\p{{N}}--[{newer}]]", "S": r"\s"}
    return re.compile(plain), regex.compile("(?V1)" + SPLIT.format(**sets))


class MergeAutomaton:
    """The automaton of a vocabulary's merges. ``labels`` has the bytes of each arc's token."""

    def __init__(self, vocab: dict[bytes, int], merges: list[tuple[bytes, bytes]], special: dict[str, int]):
        self.special = special
        self.labels = [b""] * (max([*vocab.values(), *special.values(), -1]) + 1)
        for label, token in vocab.items():
            self.labels[token] = label
        for text, token in special.items():
            self.labels[token] = text.encode()
        self.names = [str(token) for token in range(len(self.labels))]
        self.removed: dict[tuple[int, int], int] = {}
        self.copied: dict[int, tuple[int, int, int]] = {}
        arcs = {label: token for label, token in vocab.items() if len(label) == 1}
        for rank, (u, v) in enumerate(merges):
            self._add_gadget(rank, u, v, vocab, arcs)
        self.arcs = arcs
        self.lengths = self._lengths(arcs)
        self.shorter = {token: self._shorter(label) for label, token in arcs.items()}
        self.cut_latin, self.cut_other = _splitters()
        self.other = re.compile(f"[^\\x00-{chr(LATIN_END - 1)}]")
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.words: dict[str, tuple[int, ...]] = {}
        self.open: dict[int, bool] = {}

    def _add_gadget(self, rank: int, u: bytes, v: bytes, vocab: dict[bytes, int], arcs: dict[bytes, int]) -> None:
        before, after, joined = vocab[u], vocab[v], vocab[u + v]
        if u in arcs and v in arcs and self.has_arc(before, after):
            arcs[u + v] = joined
            self.copied[joined] = (before, after, rank)
        self.removed[before, after] = rank

    def _shorter(self, label: bytes) -> int:
        return next((self.arcs[label[:n]] for n in range(len(label) - 1, 0, -1) if label[:n] in self.arcs), -1)

    def has_arc(self, state: int, token: int) -> bool:
        """Whether the state behind ``state`` has an arc ``token``."""
        left, until = state, _FOREVER
        while True:
            right, since = token, _FOREVER
            while True:
                rank = self.removed.get((left, right))
                # Where both sides would merge at the same rank, the left one does.
                if rank is not None and rank < until and rank <= since:
                    return False
                if right not in self.copied:
                    break
                right, _, since = self.copied[right]
            if left not in self.copied:
                return True
            _, left, until = self.copied[left]

    def _step(self, state: int, token: int) -> bool:
        key = state << 32 | token
        known = self.open.get(key)
        if known is None:
            if len(self.open) >= REMEMBERED:
                self.open.clear()
            known = self.open[key] = self.has_arc(state, token)
        return known

    @staticmethod
    def _lengths(arcs: dict[bytes, int]) -> dict[bytes, tuple[int, ...]]:
        """How long the tokens are that start with given three bytes (fewer at the end of a word)."""
        found: dict[bytes, set[int]] = {}
        for label in arcs:
            found.setdefault(label[:3], set()).add(len(label))
        return {start: tuple(sorted(sizes, reverse=True)) for start, sizes in found.items()}

    def _first(self, word: bytes, at: int) -> int:
        """The longest token at a place of a word."""
        start = word[at : at + 3]
        for size in self.lengths.get(start, ()):
            token = self.arcs.get(word[at : at + size])
            if token is not None:
                return token
        for size in (2, 1):
            token = self.arcs.get(start[:size])
            if token is not None:
                return token
        raise ValueError(f"byte {word[at]} is not in the vocabulary")

    def encode_word(self, word: bytes) -> tuple[int, ...]:
        """The tokens on the one accepted path of a word."""
        path: list[int] = []
        dead: set[int] = set()
        labels, shorter, first, is_open = self.labels, self.shorter, self._first, self.open
        at, size, token = 0, len(word), first(word, 0)
        while True:
            while token >= 0:
                end = at + len(labels[token])
                if end not in dead:
                    if not path:
                        break
                    known = is_open.get(path[-1] << 32 | token)
                    if known or known is None and self._step(path[-1], token):
                        break
                token = shorter[token]
            if token < 0:
                dead.add(at)
                token = path.pop()
                at -= len(labels[token])
                token = shorter[token]
                continue
            path.append(token)
            if end == size:
                return tuple(path)
            at, token = end, first(word, end)

    def split(self, text: str) -> list[str]:
        """The words of a text."""
        return (self.cut_other if self.other.search(text) else self.cut_latin).findall(text)

    def encode(self, text: str) -> list[int]:
        """The tokens of a text; the texts of special tokens become those tokens."""
        ids: list[int] = []
        for i, part in enumerate(self.at_special.split(text) if self.at_special else [text]):
            if i % 2:
                ids.append(self.special[part])
                continue
            words = self.split(part)
            known = list(map(self.words.get, words))
            if None in known:
                known = [found or self._remember(word) for word, found in zip(words, known)]
            ids += chain.from_iterable(known)
        return ids

    def _remember(self, word: str) -> tuple[int, ...]:
        found = self.words.get(word)
        if found is None:
            found = self.encode_word(word.encode("utf-8", "replace"))
            if len(word) <= 64:
                if len(self.words) >= REMEMBERED:
                    self.words.clear()
                self.words[word] = found
        return found

    def decode(self, ids: list[int]) -> str:
        """The text of tokens: the arcs' labels one after the other."""
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", "replace")


def compile_automaton(raw: bytes) -> MergeAutomaton:
    """The automaton of a byte-level vocabulary file of the ``tokenizers`` library; kept per process."""
    key = hashlib.sha256(raw).hexdigest()
    if key not in _COMPILED:
        file = json.loads(raw)
        letters = byte_letters()
        to_bytes = lambda text: bytes(letters[c] for c in text)
        added = {token["content"]: token["id"] for token in file["added_tokens"]}
        vocab = {to_bytes(text): token for text, token in file["model"]["vocab"].items() if text not in added}
        pairs = [tuple(pair.split(" ")) if isinstance(pair, str) else pair for pair in file["model"]["merges"]]
        _COMPILED.clear()
        _COMPILED[key] = MergeAutomaton(vocab, [(to_bytes(u), to_bytes(v)) for u, v in pairs], added)
    return _COMPILED[key]


def _read(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def token_ids(text: Column | str, df: DataFrame, vocabulary: str) -> Column:
    """The token ids of a text column (``array<int>``); none for a null or empty text."""
    return _over(df, vocabulary, "array<int>", lambda a, texts: pd.Series([a.encode(t or "") for t in texts]))(text)


def texts_of(ids: Column | str, df: DataFrame, vocabulary: str) -> Column:
    """The text of an ``array<int>`` column of token ids; empty for null."""
    return _over(df, vocabulary, "string", lambda a, rows: pd.Series([a.decode([] if r is None else list(r)) for r in rows]))(ids)


def _over(df: DataFrame, vocabulary: str, kind: str, work):
    # A vocabulary file has a fixed size of a few MB: the driver reads it, each executor gets it once.
    small_batches(df.sparkSession)
    raw = df.sparkSession.sparkContext.broadcast(_read(vocabulary))
    return F.pandas_udf(lambda rows: work(compile_automaton(raw.value), rows), kind)


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _round_trip(automaton: MergeAutomaton, texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        ids = automaton.encode(text or "")
        rows.append((len(ids), _digest(",".join(map(automaton.names.__getitem__, ids))), _digest(automaton.decode(ids))))
    return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])


def with_encoding(df: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """``df`` with ``n_tokens`` and the SHA-256 of the ids (joined by commas) and of the decoded text.

    Whole texts; null counts as empty. Each row stands by itself, so repeated rows give equal
    results and an empty table an empty one. Columns of ``df`` with the new names are replaced.
    No shuffle.
    """
    names = [field.split()[0] for field in FIELDS.split(", ")]
    return beside(df, _over(df, vocabulary, FIELDS, _round_trip)(F.col(text)), names)
