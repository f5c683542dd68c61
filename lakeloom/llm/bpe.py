"""Byte-level BPE by traversal of a trie of words, and the way back from ids to text.

The last token of a word's encoding is enough to know all of it: what stands before that
token is encoded as if it stood alone. So every node of a trie of words has one state, the
last token of the prefix that leads to it. New words of a batch go into a trie, which is
walked depth first; the state of a node is the one suffix of its prefix that is a token and
may follow the state where that suffix begins. Words with a common prefix share its states.
Two tokens may follow one another if merging their joined bytes ends in just these two.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakeloom.llm.tokens import ID, LONGEST_KEPT, MOST_KEPT, PartwiseEncoder

#: Words that one trie holds, and pairs of tokens whose fit is remembered.
TRIE_WORDS, MOST_PAIRS = 50_000, 2_000_000


def byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a letter: printable ones as themselves,
    the others, in order, as letters from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def newer_characters() -> str:
    """Characters that the splitting pattern's library knows and Unicode as this Python has
    it does not yet. The tokenizers library may class them otherwise, so texts that hold
    one are split by that library."""
    import regex

    unknown = "".join(c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn")
    return "".join(regex.findall(r"\P{Cn}", unknown))


class Vocabulary:
    """Tokens and merges of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        letters = byte_of_letter()
        to_bytes = lambda token: bytes(letters[c] for c in token)
        model = content["model"]
        self.ids = {to_bytes(token): number for token, number in model["vocab"].items()}
        self.special = {a["content"]: a["id"] for a in content["added_tokens"]}
        self.bytes_of = {number: token for token, number in self.ids.items()}
        self.bytes_of |= {number: text.encode() for text, number in self.special.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = {(to_bytes(a), to_bytes(b)): rank for rank, (a, b) in enumerate(pairs)}

    def merge(self, word: bytes) -> list[bytes]:
        """The rule itself: join the pair of lowest rank, the first of equals, until none is left."""
        tokens = [word[i : i + 1] for i in range(len(word))]
        while len(tokens) > 1:
            ranks = [self.merges.get(pair, len(self.merges)) for pair in zip(tokens, tokens[1:], strict=False)]
            best = min(ranks)
            if best == len(self.merges):
                break
            at = ranks.index(best)
            tokens[at : at + 2] = [tokens[at] + tokens[at + 1]]
        return tokens


class PrefixEncoder(PartwiseEncoder):
    """Ids of whole texts by the trie."""

    def __init__(self, path: str):
        import regex
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        super().__init__()
        self.vocabulary = Vocabulary(path)
        self._words = regex.compile(PATTERN)
        self._special = regex.compile("(" + "|".join(map(regex.escape, self.vocabulary.special)) + ")")
        self._newer = frozenset(newer_characters())
        self._by_library = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self._known: dict[str, bytes] = {}
        self._fits: dict[int, bool] = {}
        # Tokens from their last byte to their first, as a flat trie: node and byte to node.
        self._backward: dict[int, int] = {}
        self._token_at: dict[int, int] = {}
        for token, number in self.vocabulary.ids.items():
            node = 0
            for byte in reversed(token):
                node = self._backward.setdefault(node << 8 | byte, len(self._backward) + 1)
            if self.vocabulary.merge(token) == [token]:
                self._token_at[node] = number

    def _may_follow(self, first: int, second: int) -> bool:
        key = first << 32 | second
        found = self._fits.get(key)
        if found is None:
            if len(self._fits) >= MOST_PAIRS:
                self._fits.clear()
            a, b = self.vocabulary.bytes_of[first], self.vocabulary.bytes_of[second]
            found = self._fits[key] = self.vocabulary.merge(a + b) == [a, b]
        return found

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of words given in sorted order of their bytes, each no more than once."""
        # Inserted in sorted order, nodes are numbered in depth-first order.
        child: dict[int, int] = {}
        byte_at, depth_at, ends = bytearray(1), [0], {}
        for place, word in enumerate(words):
            node = 0
            for depth, byte in enumerate(word.encode(), 1):
                key = node << 8 | byte
                node = child.get(key, 0)
                if not node:
                    node = child[key] = len(depth_at)
                    byte_at.append(byte)
                    depth_at.append(depth)
            ends[node] = place
        del child
        prefix, state = bytearray(), [-1]
        backward, token_at, length_of = self._backward, self._token_at, self.vocabulary.bytes_of
        out = [b""] * len(words)
        for node in range(1, len(depth_at)):
            depth = depth_at[node]
            del prefix[depth - 1 :], state[depth:]
            prefix.append(byte_at[node])
            at, start, fitting = 0, depth, []
            while start:
                at = backward.get(at << 8 | prefix[start - 1])
                if at is None:
                    break
                start -= 1
                if at in token_at:
                    fitting.append((token_at[at], start))
            for token, start in reversed(fitting):
                if not start or self._may_follow(state[start], token):
                    state.append(token)
                    break
            if node in ends:
                ids, end = [], depth
                while end:
                    ids.append(state[end])
                    end -= len(length_of[state[end]])
                out[ends[node]] = np.array(ids[::-1], dtype=ID).tobytes()
        return out

    def _encode_split(self, split: list[list[str]]) -> list[bytes]:
        """Ids of texts that are split into words; a special token stands as its own id."""
        new = {w for words in split for w in words if w.__class__ is str}
        new = sorted(new.difference(self._known), key=str.encode)
        long: dict[str, bytes] = {}
        if len(self._known) + len(new) > MOST_KEPT:
            wanted = {w for words in split for w in words if w.__class__ is str}
            long = {w: self._known[w] for w in wanted if w in self._known}
            self._known = {}
        for i in range(0, len(new), TRIE_WORDS):
            some = new[i : i + TRIE_WORDS]
            for word, ids in zip(some, self.encode_words(some), strict=True):
                (self._known if len(word) <= LONGEST_KEPT else long)[word] = ids
        known = self._known
        return [b"".join([w if w.__class__ is bytes else known.get(w) or long[w] for w in words]) for words in split]

    def _plain_words(self, text: str) -> list[str]:
        if not text.isascii() and not self._newer.isdisjoint(text):
            return [text[a:b] for _, (a, b) in self._by_library(text)]
        return self._words.findall(text)

    def _split(self, text: str) -> list:
        special = self.vocabulary.special
        if not any(token in text for token in special):
            return self._plain_words(text)
        out: list = []
        for piece in self._special.split(text):
            if piece in special:
                out.append(np.array([special[piece]], dtype=ID).tobytes())
            else:
                out += self._plain_words(piece)
        return out

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(x, dtype=ID) for x in self._encode_split([self._split(t) for t in texts])]

    def _learn(self, parts: list[str]) -> dict[str, bytes]:
        return dict(zip(parts, self._encode_split([self._split(" " + p) for p in parts]), strict=True))

    def decode(self, ids: bytes) -> str:
        """The text of ids, special tokens as their strings; broken UTF-8 shows as U+FFFD."""
        table = self.vocabulary.bytes_of
        return b"".join([table[i] for i in np.frombuffer(ids, dtype=ID).tolist()]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def prefix_encoder(path: str) -> PrefixEncoder:
    """One encoder for each vocabulary file and Python worker."""
    return PrefixEncoder(path)


def encode(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id and ``ids`` of each row's whole text. A null text counts as empty and has no
    ids; repeated rows stay; columns other than the two named are not read."""
    key = docs.schema[id_column]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = prefix_encoder(vocabulary).encode([t or "" for t in batch.column(1).to_pylist()])
            arrays = [np.frombuffer(x, dtype=ID).astype(np.int32) for x in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(arrays, pa.list_(pa.int32()))], [key.name, "ids"])

    return docs.select(id_column, text_column).mapInArrow(run, f"`{key.name}` {key.dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """The id and ``text`` of each row's ids; null ids give an empty text."""
    key = encoded.schema[id_column]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [prefix_encoder(vocabulary).decode(np.array(x or [], dtype=ID).tobytes()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [key.name, "text"])

    return encoded.select(id_column, ids_column).mapInArrow(run, f"`{key.name}` {key.dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``n_tokens``, ``ids_sha256`` (ids as little-endian unsigned 32-bit integers) and
    ``decoded_sha256`` (UTF-8 of the text decoded from those ids) of each row."""
    key = docs.schema[id_column]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = prefix_encoder(vocabulary)
        for batch in batches:
            found = coder.encode([t or "" for t in batch.column(1).to_pylist()])
            columns = [
                pa.array([len(x) // ID.itemsize for x in found], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in found], pa.string()),
                pa.array([hashlib.sha256(coder.decode(x).encode()).hexdigest() for x in found], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], [key.name, "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = f"`{key.name}` {key.dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select(id_column, text_column).mapInArrow(run, schema)
